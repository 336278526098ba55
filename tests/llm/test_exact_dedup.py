"""Exact duplicates against a dictionary, with digests that collide, and defined cases."""

import hashlib
import re

from pyspark.sql import functions as F

from riskbook.llm import exact_dedup as ed

SCHEMA = "doc_id long, text string, norm string, digest int, task string"
WHITE = re.compile(r"[\x20\x09-\x0D]")


def _expected(docs):
    groups = {}
    for key, text in docs:
        groups.setdefault(WHITE.sub("", text or ""), []).append((-len(text or ""), key is None, key))
    out = []
    for key, text in docs:
        norm = WHITE.sub("", text or "")
        keep = min(groups[norm], key=lambda o: (o[0], o[1], o[2] or 0))[2]
        out.append((key, keep, len(groups[norm]), key == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def _docs():
    texts = [
        None, "", " \t\n", "a b", "ab", "a\vb\r", "a b", "é　x", "é x", "🙂 a", "🙂a ", "ab", "x" * 200_000,
        "x" * 100_000 + " " + "x" * 100_000,
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [(100 + i, "hot text") for i in range(300)] + [(900, "hot  text"), (901, "hot  text"), (None, "é x"), (3, "a b")]


def _frame(spark, docs, parts=7):
    return spark.createDataFrame([(k, t, "clash", 1, "task") for k, t in docs], SCHEMA).repartition(parts)


def _rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def test_same_groups_as_a_dictionary(spark):
    docs = _docs()
    assert _rows(ed.duplicate_groups(_frame(spark, docs))) == _expected(docs)


def test_equal_digests_of_different_texts_do_not_meet(spark):
    docs = _docs()
    weak = ed.duplicate_groups(_frame(spark, docs), digest=lambda norm: F.length(norm) % 3)
    assert _rows(weak) == _expected(docs)
    constant = ed.duplicate_groups(_frame(spark, docs), digest=lambda norm: F.lit(1))
    assert _rows(constant) == _expected(docs)


def test_one_whole_row_stays_for_each_text(spark):
    docs = _docs()
    kept = ed.drop_duplicates(_frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "norm", "digest", "task"]
    rows = kept.collect()
    wanted = {(keep, digest) for _, keep, _, _, digest in _expected(docs)}
    found = [(r.doc_id, hashlib.sha256(WHITE.sub("", r.text or "").encode()).hexdigest()) for r in rows]
    assert len(found) == len(set(found)) and set(found) == wanted


def test_empty_table(spark):
    assert _rows(ed.duplicate_groups(_frame(spark, []))) == []
    assert ed.drop_duplicates(_frame(spark, [])).count() == 0


def test_a_salted_group_has_few_rows_of_a_text_that_fills_the_table(spark):
    docs = spark.range(0, 5000, 1, 100).select(F.col("id").alias("doc_id"), F.lit("one").alias("text"))
    salted = docs.select(ed._salt().alias("salt"), F.spark_partition_id().alias("task")).distinct()
    held = [r["count"] for r in salted.groupBy("salt").count().collect()]
    assert len(held) == 10 and max(held) <= 19
