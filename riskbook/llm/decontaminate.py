"""Benchmark decontamination by winnowing, in DataFrame operations alone.

Of every nine consecutive 5-word hashes of a text the least one is kept as a fingerprint. Two texts that share 13
consecutive words share such a window, and with it a fingerprint, wherever the words stand. The
fingerprints of documents are joined with those of the benchmark; each meeting is extended word by word, eight
words to the left and thirteen to the right of its start, which reaches every 13-word window around it. A
stretch of at least 13 equal words is a hit; items of fewer words must be met whole. Those have one
fingerprint, their first 5 words or all of fewer, which is looked for at every position.

A fingerprint is 33 bits of hash beside 31 bits of position, enough for any array; since extension
compares the words themselves, a chance meeting of hashes costs time only. Hashes take words in lower case, the
comparison only A to Z so.

Defined cases: NULL and empty texts have no words and are not contaminated; items without words hit nothing;
items with a NULL id contaminate but are not named; items with equal ids count once; repeated documents
are judged each; without items, or without documents, nothing is hit. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored, whole

WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPAN = 13  # words of a window
GRAM = 5  # words of a hash
LEFT = SPAN - GRAM
POSITION_BITS = 31
MOST_BROADCAST_KEYS = 2_000_000  # fingerprints of a benchmark, of 20 bytes each
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: str | Column) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(WORDS), F.lit(0))


def _plain(word: Column) -> Column:
    return F.translate(word, _UPPER, _LOWER)


def _positions(n: Column) -> Column:
    """0 to n - 1, nothing if n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _packed(hash_: Column, position: Column) -> Column:
    return F.shiftleft(hash_.bitwiseAND(F.lit((1 << 33) - 1)), POSITION_BITS).bitwiseOR(position.cast("bigint"))


def _grams(hashes: Column, size: int) -> Column:
    """The packed hash of every run of ``size`` words."""
    return F.transform(
        _positions(F.size(hashes) - (size - 1)),
        lambda i: _packed(F.xxhash64(*[F.get(hashes, i + j) for j in range(size)]), i),
    )


def _least_of_three(values: Column, apart: int) -> Column:
    return F.transform(
        _positions(F.size(values) - 2 * apart),
        lambda i: F.least(*[F.get(values, i + j * apart) for j in range(3)]),
    )


def _fingerprinted(rows: DataFrame, text: str, sizes: Sequence[int] = ()) -> DataFrame:
    """Add ``words``, ``n_words``, ``hashes`` and ``fingerprints``: the least of nine grams for every nine,
    and all grams of the given sizes.

    Each array is a column of its own that later ones use several times, so none is computed anew inside
    a loop over another.
    """
    hashed = (
        rows.withColumn("words", words_of(text))
        .withColumn("n_words", F.size("words").cast("bigint"))
        .withColumn("hashes", F.transform("words", lambda w: F.xxhash64(F.lower(w))))
    )
    winnowed = (
        hashed.withColumn("grams", _grams(F.col("hashes"), GRAM))
        .withColumn("threes", _least_of_three(F.col("grams"), 1))
        .withColumn("nines", _least_of_three(F.col("threes"), 3))
    )
    every = [F.array_distinct("nines"), *[_grams(F.col("hashes"), size) for size in sizes]]
    return winnowed.withColumn("fingerprints", F.concat(*every)).drop("grams", "threes", "nines")


def _key(packed: Column) -> Column:
    return F.shiftright(packed, POSITION_BITS)


def _position(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> tuple[DataFrame, DataFrame, list[int]]:
    """The items with their words, their fingerprints (item_key, item, item_at), and the gram sizes that
    short items ask for."""
    rows = benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_id).cast("string").alias("item_id"),
        F.col(item_text).alias("body"),
    )
    items = stored(_fingerprinted(rows, "body"), "benchmark")
    short = items.filter((F.col("n_words") > 0) & (F.col("n_words") < SPAN))
    size = F.least(F.col("n_words"), F.lit(GRAM)).cast("int")
    sizes = sorted(row.n for row in short.select(size.alias("n")).distinct().collect())  # at most GRAM
    packed = items.filter(F.col("n_words") >= SPAN).select("item", F.explode("fingerprints").alias("packed"))
    for n in sizes:
        first = F.get(_grams(F.col("hashes"), n), F.lit(0))
        packed = packed.unionAll(short.filter(size == n).select("item", first.alias("packed")))
    keys = packed.select(
        _key(F.col("packed")).alias("item_key"), "item", _position(F.col("packed")).alias("item_at")
    )
    return items, stored(keys, "fingerprints"), sizes


def _around(at: Column) -> list[Column]:
    """The words that extension can reach from a position of ``words``."""
    left = F.least(at, F.lit(LEFT))
    return [F.slice("words", at - left + 1, left).alias("before"), F.slice("words", at + 1, F.lit(SPAN)).alias("after")]


def _opened(rows: DataFrame, keys: DataFrame, sizes: list[int], most_keys: int) -> DataFrame:
    """One row (row, doc, n_words) per document, with NULL ``at``; and one (row, at, item, item_at, before,
    after) wherever a fingerprint of a document is one of an item.

    Fingerprints of a benchmark that are counted to be no more than ``most_keys`` are broadcast, so each text
    is read once and nothing of it is moved. More of them are joined by shuffling the documents'
    fingerprints, and the texts that met an item are then fetched by row.
    """
    base = _fingerprinted(rows, "body", sizes)
    if keys.count() <= most_keys:
        # The first of each document's rows stands for the document itself.
        each = base.select(
            "row", "doc", "words", "n_words",
            F.explode(F.concat(F.array(F.lit(None).cast("bigint")), F.col("fingerprints"))).alias("packed"),
        )
        met = each.join(F.broadcast(keys), _key(F.col("packed")) == F.col("item_key"), "left")
        first = F.col("packed").isNull()
        at = _position(F.col("packed"))
        return stored(
            met.filter(first | F.col("item").isNotNull()).select(
                "row", F.when(first, F.col("doc")).alias("doc"), F.when(first, F.col("n_words")).alias("n_words"),
                at.alias("at"), "item", "item_at", *_around(at),
            ),
            "opened",
        )
    numbered = stored(base.select("row", "doc", "body", "n_words", "fingerprints"), "numbered")
    each = numbered.select("row", F.explode("fingerprints").alias("packed"))
    met = each.join(keys, _key(F.col("packed")) == F.col("item_key")).select(
        F.col("row").alias("met_row"), F.struct(_position(F.col("packed")).alias("at"), "item", "item_at").alias("m")
    )
    per_row = stored(met.groupBy("met_row").agg(F.collect_list("m").alias("met")), "met")
    texts = numbered.join(per_row, F.col("row") == F.col("met_row")).select("row", words_of("body").alias("words"), "met")
    exploded = texts.select("row", "words", F.explode("met").alias("m")).select("row", "words", "m.*")
    found = exploded.select("row", "at", "item", "item_at", *_around(F.col("at")))
    return numbered.select("row", "doc", "n_words").unionByName(found, allowMissingColumns=True)


def _run(flags: Column) -> Column:
    """How many true values stand at the front."""
    return F.array_position(F.array_append(flags, F.lit(False)), F.lit(False)).cast("int") - 1


def _hits(opened: DataFrame, items: DataFrame) -> DataFrame:
    """The stretches of documents that are windows of items: (row, start, end, item_id)."""
    context = items.select(
        F.col("item").alias("i"), "item_id", F.col("n_words").alias("item_n"),
        F.transform("words", _plain).alias("item_words"),
    )
    met = opened.filter(F.col("at").isNotNull()).select("row", "at", "item", "item_at", "before", "after")
    left = F.least(F.col("item_at"), F.lit(LEFT))
    near = met.join(context, F.col("item") == F.col("i")).select(
        "row", "at", "item_id", "before", "after",
        F.least(F.col("item_n"), F.lit(SPAN)).cast("int").alias("need"),
        F.slice("item_words", F.col("item_at") - left + 1, left).alias("item_before"),
        F.slice("item_words", F.col("item_at") + 1, F.lit(SPAN)).alias("item_after"),
    )
    same = lambda a, b: F.coalesce(a == b, F.lit(False))
    before = F.reverse(F.transform("before", _plain))
    runs = near.select(
        "row", "at", "item_id", "need",
        _run(F.zip_with(before, F.reverse("item_before"), same)).alias("l"),
        _run(F.zip_with(F.transform("after", _plain), F.col("item_after"), same)).alias("r"),
    )
    return runs.filter((F.col("r") > 0) & (F.col("l") + F.col("r") >= F.col("need"))).select(
        "row", (F.col("at") - F.col("l")).alias("start"), (F.col("at") + F.col("r")).alias("end"), "item_id"
    )


def _judged(rows: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, most_keys: int) -> tuple[DataFrame, DataFrame]:
    """From rows (row, doc, body): all (row, doc, n_words), and (hit_row, n_hit, items) of those with hits."""
    items, keys, sizes = _items(benchmark, item_id, item_text)
    opened = _opened(rows, keys, sizes, most_keys)
    hits = stored(_hits(opened, items), "hits")
    covered = (
        hits.select("row", F.explode(F.sequence("start", F.col("end") - 1)).alias("at"))
        .distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = hits.groupBy(F.col("row").alias("named_row")).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    judged = covered.join(named, F.col("row") == F.col("named_row")).select(F.col("row").alias("hit_row"), "n_hit", "items")
    return opened.filter(F.col("at").isNull()).select("row", "doc", "n_words"), stored(judged, "judged")


def contamination(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", most_keys: int = MOST_BROADCAST_KEYS,
) -> DataFrame:
    """Per document: its id, n_words, n_hit, n_items, items (an array of ids as text), contaminated."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc"), F.col(text).alias("body"))
    every, judged = _judged(rows, benchmark, item_id, item_text, most_keys)
    joined = every.join(judged, F.col("row") == F.col("hit_row"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("doc").alias(doc_id), "n_words", n_hit.alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        items.alias("items"), _contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * 20 >= n_words)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    most_keys: int = MOST_BROADCAST_KEYS,
) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    everything = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(F.monotonically_increasing_id().alias("row"), everything.alias("doc"), F.col(text).alias("body"))
    every, judged = _judged(rows, benchmark, item_id, item_text, most_keys)
    counted = judged.join(every.select("row", "n_words"), F.col("row") == F.col("hit_row"))
    bad = counted.filter(_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("row").alias("bad_row"))
    return every.join(stored(bad, "bad"), F.col("row") == F.col("bad_row"), "left_anti").select("doc.*")


def digested(found: DataFrame) -> DataFrame:
    """The items as one digest: lower-case hex sha256 of the ids, sorted as text and joined by commas."""
    digest = F.sha2(F.array_join("items", ","), 256)
    return found.withColumn("items_sha256", digest).drop("items")
