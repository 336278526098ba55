"""Mixing sources to target weights.

Every row gets a random but repeatable key, the md5 of its id and size. The keys of a source are cut into
about sqrt(rows) equal ranges, so both levels of the prefix sum, over the ranges of a source and over
the rows of a range, handle about sqrt(rows) values however large the source is. A source is taken as many
whole times as its target allows, and the rest is cut off the key order exactly at the budget: the last
document taken is taken in part, counted in words.

Targets: sources in code point order, NULL last, weigh 1, 2, 3, repeating. They share the budget (all
sizes together) by weight; none gets more than three times its size, and what it cannot take is shared
again by weight.

Defined cases: a NULL text has size 0, NULL sources are one source, empty tables give no rows, repeated
rows are rows of their own (equal rows may differ in what is taken of them, their number may not), rows
with a NULL id are keyed by their size. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lcm

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from riskbook.llm.common import WORD, stored, whole

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
KEY_BITS = 40


def word_count(text: str | Column) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("bigint")


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """Per source: rows, size, weight, target, whole epochs and the words of the last, partial one.

    In ascending order of cap / weight the capped sources come first, and a source is capped when its
    share of what the ones before it leave is more than its cap.
    """
    per_source = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("source_rows"), F.sum("size").alias("source_size")
    )
    # One row per source from here on.
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    choices = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighted = per_source.withColumn(
        "weight", F.get(choices, (F.row_number().over(by_name) - 1) % len(weights))
    )
    everything = Window.partitionBy()
    ascending = Window.orderBy(
        F.col("source_size") * F.expr(f"{lcm(*weights)} div weight"),
        F.col("source").isNull(),
        "source",
    )
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    onward = ascending.rowsBetween(0, Window.unboundedFollowing)
    cap = F.col("source_size") * most_epochs
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0))
    ranked = weighted.select(
        "*", cap.alias("cap"), left.alias("left"), F.sum("weight").over(onward).alias("open_weight")
    ).withColumn(
        "capped",
        _exact(F.col("weight")) * _exact(F.col("left"))
        > _exact(F.col("cap")) * _exact(F.col("open_weight")),
    )
    free = ~F.col("capped")
    share = F.max(F.when(free, F.col("left"))).over(everything)
    share_weight = F.max(F.when(free, F.col("open_weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        (F.col("weight") * share).cast("double") / share_weight.cast("double")
    )
    budget = F.floor("target").cast("bigint")
    epochs = F.coalesce(F.try_divide(budget - budget % F.nullif("source_size", F.lit(0)), "source_size"), F.lit(0))
    return ranked.withColumn("target", target).select(
        "source", "source_rows", "source_size", "target",
        epochs.cast("bigint").alias("epochs"),
        (budget - epochs.cast("bigint") * F.col("source_size")).alias("rest"),
        F.ceil(F.sqrt("source_rows")).cast("bigint").alias("ranges"),
    )


def taken_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    carry: Sequence[str] = (),
    weights: Sequence[int] = WEIGHTS,
) -> DataFrame:
    """Per row: the ``carry`` columns, key, size, source_size, target, taken."""
    size = word_count(text)
    digest = F.md5(
        F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(":"), size.cast("string"))
    )
    sizes = stored(
        docs.select(
            *[F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)],
            F.col(key).alias("id"), F.col(source).cast("string").alias("source"),
            size.alias("size"), digest.alias("digest"),
        ),
        "sizes",
    )
    targets = stored(source_targets(sizes, weights), "targets").withColumnRenamed("source", "name")
    place = F.conv(F.substring("digest", 1, KEY_BITS // 4), 16, 10).cast("bigint")
    rows = sizes.join(targets, F.col("source").eqNullSafe(F.col("name"))).withColumn(
        "range", F.shiftright(place * F.col("ranges"), KEY_BITS)
    )
    totals = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    over_ranges = Window.partitionBy("source").orderBy("range")
    offsets = totals.select(
        F.col("source").alias("o_source"), F.col("range").alias("o_range"),
        (F.sum("range_size").over(over_ranges) - F.col("range_size")).alias("before_range"),
    )
    in_range = Window.partitionBy("source", "range").orderBy("digest", "id")
    inside = F.sum("size").over(in_range.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    summed = rows.withColumn("inside", inside).join(
        offsets,
        F.col("source").eqNullSafe(F.col("o_source")) & (F.col("range") == F.col("o_range")),
    )
    part = F.col("rest") - F.col("before_range") - F.col("inside")
    taken = F.col("epochs") * F.col("size") + F.least("size", F.greatest(part, F.lit(0)))
    return summed.select(
        *[F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)],
        F.col("id").alias(key), "size", "source_size", "target", taken.cast("bigint").alias("taken"),
    )


@F.pandas_udf(StringType())
def _first_words(text: pd.Series, count: pd.Series) -> pd.Series:
    import re
    from itertools import islice

    def cut(value, n):
        if value is None or n is None:
            return value
        ends = [m.end() for m in islice(re.finditer(r"[^ \t-\r]+", value), int(n) - 1, int(n))]
        return value[: ends[0]] if ends else ""

    return pd.Series([cut(t, n) for t, n in zip(text, count)], dtype=object)


def mix(docs: DataFrame, key: str = "doc_id", weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """The mixed rows, with the columns of ``docs``: whole documents once per epoch that takes them, and
    per source at most one document cut after the last word within the budget (``n_chars``, if there,
    is that of the cut text)."""
    everything = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("row"), everything.alias("doc")), "numbered")
    named = numbered.select("row", *[F.col(f"doc.`{c}`").alias(c) for c in (key, "text", "source")])
    taken = taken_words(named, key=key, carry=["row"], weights=weights)
    plan = taken.select(
        F.col("row").alias("taken_row"),
        F.expr("CASE WHEN size > 0 THEN taken div size ELSE 0 END").alias("wholes"),
        F.expr("CASE WHEN size > 0 THEN taken % size ELSE 0 END").alias("part"),
    ).filter((F.col("wholes") > 0) | (F.col("part") > 0))
    copies = F.concat(
        F.array_repeat(F.lit(None).cast("bigint"), F.col("wholes").cast("int")),
        F.when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<bigint>")),
    )
    rows = numbered.join(plan, F.col("row") == F.col("taken_row")).select("doc", F.explode(copies).alias("cut"))
    is_cut = F.col("cut").isNotNull()
    rows = rows.select("doc", "cut", _first_words(F.when(is_cut, F.col("doc.text")), F.col("cut")).alias("head"))
    changed = {"text": F.col("head"), "n_chars": F.length("head").cast("bigint")}
    columns = []
    for name in docs.columns:
        column = F.col(f"doc.`{name}`")
        if name in changed:
            column = F.when(is_cut, changed[name]).otherwise(column)
        columns.append(column.alias(name))
    return rows.select(*columns)
