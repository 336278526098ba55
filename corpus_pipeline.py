"""From raw documents to token files: rules, near duplicates, benchmark passages, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and gives the documents it keeps, with their columns; the last one
gives what its token files hold. A stage begins by removing the intermediate tables of the stages that its docs
come from, whose results are written by then, and no others. The first column's metadata tells which stage docs
come from; where a store loses it, the tables stay until the session ends. ``run`` writes each stage's result to the shared folder and reads it back
for the next.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskbook.llm import decontaminate, mixing, near_dedup, quality_rules, token_files
from riskbook.llm.common import Scope, read_table, stored
from riskbook.llm.queries import END_ID, VOCABULARY

SHINGLE_WORDS = 5
SCOPE = "riskbook_stage"
_SCOPES: dict[str, Scope] = {}


def _scope_of(docs: DataFrame) -> Scope | None:
    return _SCOPES.get(docs.schema[0].metadata.get(SCOPE, ""))


def staged(build):
    """A stage with a scope of its own for the tables it stores."""

    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = _scope_of(docs)
        if before is not None:
            before.discard_all_but(docs)
        scope = Scope(before)
        _SCOPES[scope.name] = scope
        with scope:
            result = build(spark, docs, sf_dir)
        return result.withMetadata(result.columns[0], {SCOPE: scope.name})

    return run_stage


@staged
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep_quality(docs)


@staged
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs, size=SHINGLE_WORDS)


@staged
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark items do not contaminate."""
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


@staged
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the amounts that the weights of their sources ask for."""
    return mixing.mix(docs)


@staged
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the token files: doc_id, start, n_tokens, ids_crc32."""
    return token_files.tokenized(docs, public_tokenizers.path(VOCABULARY), END_ID)


STAGES = [
    ("quality_rules", quality),
    ("near_dedup", near_duplicates),
    ("decontamination", benchmark_passages),
    ("source_mixing", source_mix),
    ("token_files", tokens),
]

# No SQL states the sketches, the tokenizer or the coder; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        with _scope_of(docs):
            docs = stored(docs, f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
