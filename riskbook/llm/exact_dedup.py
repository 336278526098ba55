"""Exact duplicates by content, combined in three stages so that no key is ever gathered in one task.

Texts are equal when they are identical without their ASCII white space. Every stage groups by a digest and
by the normalised text itself, so equal digests of different texts never meet as one:

1. *locally*: the map side of the first aggregation combines the equal texts of each input task, and spills to
   disk where they do not fit;
2. *by salt*: what is left, at most one row per text and task, meets by digest and salt. The tasks up to number
   p share about sqrt(p) salts, so a text that fills the table brings about sqrt(tasks) rows to a salted group;
3. *globally*: the winners of the salts meet by digest, again about sqrt(tasks) rows at most.

The result goes back to the documents by digest and input task, so a text with a third of all rows is spread over
as many join keys as it has tasks. Should two texts share a digest, their documents are joined by content instead.

Defined cases: a NULL text is empty, and all texts without anything but white space are equal; of equal texts the
one with the most code points stays, then the one with the least id, NULL ids last; repeated rows with one id and equal
texts are one document and get the same verdict in :func:`duplicate_groups`, while :func:`drop_duplicates` keeps one
of them; an empty table gives no rows. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored, whole

WHITE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text without its ASCII white space."""
    return F.regexp_replace(text, WHITE, "")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _order(text: Column, key: Column) -> Column:
    """The least of equal texts stays."""
    return F.struct((-F.length(text)).alias("few"), key.isNull().alias("no_id"), key.alias("id"))


def _salt() -> Column:
    return F.floor(F.sqrt(F.spark_partition_id().cast("double")))


def _combined(rows: DataFrame) -> DataFrame:
    """The least ``best`` and the number of rows per digest and text: by salt, then over all salts."""
    for keys in (("digest", "salt", "norm"), ("digest", "norm")):
        rows = rows.groupBy(*keys).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    return rows


def duplicate_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Per document: its id, keep_id (id of the document that stays), group_size, kept, text_sha256.

    ``digest`` only decides how texts are dealt out; any function of the normalised text gives the same rows.
    """
    original, key = whole(F.col(text)), F.col(doc_id)
    norm = normalised(original)
    rows = stored(
        docs.select(
            key.alias("id"), sha256(norm).alias("sha"), F.spark_partition_id().alias("task"),
            *([] if digest is sha256 else [digest(norm).alias("digest")]),
        ),
        "digests",
    )
    if digest is sha256:
        rows = rows.withColumn("digest", F.col("sha"))
    contents = _combined(
        docs.select(
            digest(norm).alias("digest"), _salt().alias("salt"), norm.alias("norm"),
            _order(original, key).alias("best"), F.lit(1).cast("bigint").alias("n"),
        )
    )
    classes = stored(contents.select("digest", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size")), "classes")
    shared = stored(classes.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1"), "shared")
    if shared.isEmpty():
        verdicts = _by_digest(rows, classes)
    else:
        rest = _by_digest(
            rows.join(shared, "digest", "left_anti"), classes.join(shared, "digest", "left_anti")
        )
        verdicts = rest.unionByName(_by_content(docs, contents.join(shared, "digest", "left_semi"), norm, key, digest))
    return verdicts.select(
        F.col("id").alias(doc_id),
        F.col("keep_id"),
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _by_digest(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Verdicts where a digest stands for one text."""
    spread = rows.select("digest", "task").distinct().join(classes, "digest")
    return rows.join(spread, ["digest", "task"]).select("id", "sha", "keep_id", "group_size")


def _by_content(docs: DataFrame, contents: DataFrame, norm: Column, key: Column, digest) -> DataFrame:
    """Verdicts of the documents whose digest several texts share."""
    classes = contents.select("digest", "norm", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"))
    texts = docs.select(key.alias("id"), digest(norm).alias("digest"), norm.alias("norm"), sha256(norm).alias("sha"))
    return texts.join(classes, ["digest", "norm"]).select("id", "sha", "keep_id", "group_size")


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, with all their columns, without exact duplicates. Whole rows travel with the texts, so this
    needs no join and gives one row for each text, also where ids repeat. Rows of one id and one length are told
    apart by a hash of all their columns."""
    original = whole(F.col(text))
    norm = normalised(original)
    every = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        sha256(norm).alias("digest"), _salt().alias("salt"), norm.alias("norm"),
        F.struct(_order(original, F.col(doc_id)).alias("first"), F.xxhash64(*every).alias("hash")).alias("order"),
        F.struct(*every).alias("doc"),
    )
    for keys in (("digest", "salt", "norm"), ("digest", "norm")):
        rows = rows.groupBy(*keys).agg(F.min_by("doc", "order").alias("doc"), F.min("order").alias("order"))
    return rows.select("doc.*")
