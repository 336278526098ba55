"""The registered queries, one per operator, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskbook.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    html_text,
    merkle,
    mixing,
    near_dedup,
    oracles,
    pii,
    quality_classifier,
    quality_rules,
    spelling,
    token_files,
    url_filters,
)
from riskbook.llm.common import read_table

VOCABULARY = "word_bpe_49k.json"
END_ID = 1

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


@query
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(read_table(spark, sf_dir, "documents"))


@query
def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = (read_table(spark, sf_dir, name) for name in ("pages", "labels"))
    return url_filters.judge_urls(pages, url_filters.page_outcomes(labels))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


@query
def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    awkward = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-1, 0, "user", awkward), (-1, 1, "assistant", awkward)], rows.schema
    )
    return chat_format.read_back(chat_format.format_chats(rows.unionByName(extra), append_only=True))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_classifier.quality_scores(docs, labels)


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return token_files.tokenized(documents, public_tokenizers.path(VOCABULARY), END_ID)


@query
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.duplicate_groups(read_table(spark, sf_dir, "documents"), size=2)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (read_table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.digested(decontaminate.contamination(docs, benchmark)).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


ORACLES |= {
    "op2_source_mixing": oracles.MIXING,
    "op5_decontamination": oracles.DECONTAMINATION,
    "op7_url_filters": oracles.URL_FILTERS,
    "op9_quality_rules": oracles.QUALITY,
}


@query
def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digested(pii.personal_data(read_table(spark, sf_dir, "documents")))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(read_table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"), ("doc_id", "source", "lang", "n_chars", "text"))


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read_table(spark, sf_dir, "documents"))


ORACLES |= {
    "op11_spelling_variants": oracles.SPELLING,
    "op12_merkle_manifest": oracles.MERKLE,
    "op13_exact_dedup": oracles.EXACT,
}
