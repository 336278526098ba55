"""Near-duplicate documents by SetSketch registers.

A document is the set of its k-word shingles. Documents with equal sets form a class; one sketch of 288
registers per class is kept. A register is the least of one hash over the set, taken as an exponential
variate and truncated to powers of ``BASE``: sketches of parts merge by the larger register, and two registers
agree about as often as the sets overlap. Three times three registers, from different places of the sketch, make a
band; classes that agree in one of 48 bands are candidates. A pair of similarity 0.8 is missed about once in
a thousand, one of 0.85 once in a hundred thousand, while pairs of 0.65, which are many in families of
similar texts, meet in one band on average. Pairs that no hub settles also need sketches that agree nearly as much as
the limit; of pairs right at it two or three in a thousand do not, all told, of those at 0.82 one in ten thousand.

Large groups are not paired out. Every bucket names one hub, and only (hub, member) pairs are examined: first by
the likelihood of the two sketches together, which drops pairs far below the limit, then by the full sets of
words. What got linked is one component; only buckets that still hold several components go on, with other
hubs, until their remaining pairs are no more than the rows of the bucket table or hubs find no more, and
all of those pairs are compared by size, parity bits and sketch where their buckets meet; only those that may reach the limit
go on. Parity bits bound from below what only one of two sets holds, so they drop no pair that reaches the limit. The
first round takes a third of the bands, which joins most of every large
group before the others are looked at. So every candidate pair is examined or lies within one component.

Defined cases: texts without words, and NULL texts, are empty sets, linked with nothing; a text with fewer
words than a shingle is one shingle; a NULL id takes part like any other, but names no component; repeated
rows are one class; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import discard, stored
from riskbook.llm.components import components

PACKED = 6  # registers side by side in one number
BANDS = 48
REGISTERS = PACKED * BANDS
HALF_BITS = 30  # a block: three registers, half of such a number
BLOCK_STEPS = (0, 31, 58)  # a band's three blocks lie so far apart among the 96
REGISTER_BITS = 10
BASE = 1.026
RATE = 20.0  # of the exponential variates
LEAST_PERCENT = 80
SKETCH_MARGIN = 0.15  # a pair estimated this far below the limit is dropped: six deviations
EQUAL_MARGIN = 0.065  # the same for the share of equal registers where buckets are paired out: three deviations
PARITIES = 2048  # bits, each whether an odd number of a set's hashes falls on it
FIRST_BANDS = 16  # of the first round
PAIRS_PER_CLASS = 2 * BANDS  # when no more remain, all are examined
HUB_ROUNDS = 8

_MULTIPLIERS = (
    np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**32, REGISTERS, np.uint64) | np.uint64(1)
).astype(np.uint32)
_ADDENDS = np.random.Generator(np.random.PCG64(1729)).integers(0, 2**32, REGISTERS, np.uint64).astype(np.uint32)
_AT_ONCE = 512


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A to Z in lower case (bytes know no other letters)."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size))))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def hashed_sets(texts: Sequence[str | None], size: int) -> list[np.ndarray]:
    """Per text the distinct 64-bit hashes of its shingles, in order."""
    import xxhash

    by_text = [words_of(text) for text in texts]
    every = list(chain.from_iterable(by_text))
    known = {word: xxhash.xxh64_intdigest(word) for word in set(every)}
    hashes = np.fromiter(map(known.__getitem__, every), np.uint64, len(every))
    shingles = hashes.copy()
    for i in range(1, size):
        shingles = _mixed(shingles)
        left = max(0, len(hashes) - i)
        shingles[:left] += hashes[i : i + left]
    shingles = _mixed(shingles)
    sets, at = [], 0
    for words in by_text:
        n = len(words)
        if n >= size:
            sets.append(np.unique(shingles[at : at + n - size + 1]))
        elif n:
            one = xxhash.xxh64_intdigest(b" ".join(words), seed=n)
            sets.append(np.array([one], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
        at += n
    return sets


def registers(hashes: np.ndarray) -> np.ndarray:
    """The registers of a set: the larger the smaller the least hash."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), _AT_ONCE):
        block = x[at : at + _AT_ONCE, None] * _MULTIPLIERS
        block += _ADDENDS
        block ^= block >> np.uint32(15)
        np.minimum(least, (block * np.uint32(0x2C1B3C6D)).min(axis=0), out=least)
    variates = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    values = np.floor(1 - np.log(variates) / np.log(BASE))
    return np.clip(values, 0, (1 << REGISTER_BITS) - 1).astype(np.int64)


def packed(values: np.ndarray) -> np.ndarray:
    """The registers of a sketch, six to a number."""
    shifts = np.arange(PACKED, dtype=np.int64) * REGISTER_BITS
    return (values.reshape(BANDS, PACKED) << shifts).sum(axis=1)


def parities(hashes: np.ndarray) -> np.ndarray:
    """The parity bits of a set, 64 to a number. What two sets share cancels out where their bits are compared, and what
    only one holds turns one bit, so that no more bits than that differ."""
    odd = np.bincount((hashes & np.uint64(PARITIES - 1)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def unpacked(bands: np.ndarray) -> np.ndarray:
    """The registers of many sketches, from an array of their numbers."""
    shifts = np.arange(PACKED, dtype=np.int64) * REGISTER_BITS
    values = (bands.reshape(-1, BANDS, 1) >> shifts) & ((1 << REGISTER_BITS) - 1)
    return values.reshape(-1, REGISTERS)


def estimated_similarity(left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray) -> np.ndarray:
    """Most likely similarity of pairs, from how many registers of the one are larger, smaller or equal, and
    from the known sizes of the sets."""
    larger = (left > right).sum(axis=1)[:, None]
    smaller = (left < right).sum(axis=1)[:, None]
    equal = left.shape[1] - larger - smaller
    u = (left_size / (left_size + right_size))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 201)[None, :] * most

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 1e-12, 1) * (BASE - 1) / BASE) / np.log(BASE)

    above, below = chance(u - v * grid), chance(v - u * grid)
    same = np.clip(1 - above - below, 1e-12, 1)
    likelihood = larger * np.log(above) + smaller * np.log(below) + equal * np.log(same)
    return grid[np.arange(len(grid)), likelihood.argmax(axis=1)]


def _sketches(rows: DataFrame, size: int) -> DataFrame:
    """Per row: its number, id, set size, the digest of the set, the bands and the parity bits (NULL for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                counts, digests, bands, bits = [], [], [], []
                for hashes in hashed_sets(part.column(2).to_pylist(), size):
                    counts.append(len(hashes))
                    if not len(hashes):
                        digests.append(None)
                        bands.append(None)
                        bits.append(None)
                        continue
                    digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    bands.append(packed(registers(hashes)))
                    bits.append(parities(hashes))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(counts, pa.int64()),
                        pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                        pa.array(bits, pa.list_(pa.int64())),
                    ],
                    ["row", "id", "n_shingles", "digest", "bands", "bits"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    schema = f"row bigint, id {kind}, n_shingles bigint, digest binary, bands array<bigint>, bits array<bigint>"
    return rows.select("row", "id", "text").mapInArrow(run, schema)


def _block(bands: Column, number: int) -> Column:
    """One of the 96 blocks of three registers."""
    pack = bands[number // 2]
    return F.shiftrightunsigned(pack, HALF_BITS) if number % 2 else pack.bitwiseAND((1 << HALF_BITS) - 1)


def band_keys(bands: Column) -> Column:
    """The 48 keys by which sketches meet: each a hash of three blocks, 62 and 54 registers apart at the least."""
    blocks = 2 * BANDS
    return F.array(
        *[
            F.xxhash64(F.lit(band), *[_block(bands, (2 * band + step) % blocks) for step in BLOCK_STEPS])
            for band in range(BANDS)
        ]
    )


def _differences(left: Column, right: Column) -> Column:
    """The numbers of two sketches, with a zero wherever registers are equal."""
    return F.zip_with(left, right, lambda a, b: a.bitwiseXOR(b))


def _equal_registers(differences: Column) -> Column:
    """How many registers of two sketches are equal."""
    masks = [((1 << REGISTER_BITS) - 1) << REGISTER_BITS * i for i in range(PACKED)]

    def equal(d: Column) -> Column:
        return sum((F.when(d.bitwiseAND(m) == 0, 1).otherwise(0) for m in masks), F.lit(0))

    return F.aggregate(differences, F.lit(0), lambda total, d: total + equal(d))


def _first_band(differences: Column) -> Column:
    """The first band in which two sketches meet, NULL if there is none."""

    def meets(band: Column) -> Column:
        blocks = []
        for step in BLOCK_STEPS:
            pack = F.get(differences, (band + step // 2) % BANDS)
            blocks.append((F.shiftrightunsigned(pack, HALF_BITS) if step % 2 else pack.bitwiseAND((1 << HALF_BITS) - 1)) == 0)
        return blocks[0] & blocks[1] & blocks[2]

    return F.get(F.filter(F.sequence(F.lit(0), F.lit(BANDS - 1)), meets), 0)


def _fitting(u_size: Column, v_size: Column, percent: int) -> Column:
    """The larger of two sets bounds the similarity by their sizes alone."""
    return F.least(u_size, v_size) * 100 >= F.greatest(u_size, v_size) * percent


def _close(u_size: Column, u_bits: Column, v_size: Column, v_bits: Column, percent: int) -> Column:
    """Whether so few parity bits differ that the sets may reach the limit; every pair that does passes. Sets of s hashes
    together reach it if no more than s * (100 - percent) / (100 + percent) are in one of them only."""
    differing = F.zip_with(u_bits, v_bits, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    total = F.aggregate(differing, F.lit(0), lambda so_far, n: so_far + n)
    return total * (100 + percent) <= (u_size + v_size) * (100 - percent)


def _probable(pairs: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v, u_size, u_bands, v_size, v_bands) whose sketches do not speak against the limit."""
    least = percent / 100 - SKETCH_MARGIN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (unpacked(batch.column(i).flatten().to_numpy()) for i in (3, 5))
            sizes = [batch.column(i).to_numpy().astype(float) for i in (2, 4)]
            good = np.concatenate(
                [
                    estimated_similarity(left[a : a + 500], right[a : a + 500], sizes[0][a : a + 500], sizes[1][a : a + 500])
                    for a in range(0, batch.num_rows, 500)
                ]
            )
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(good >= least))

    return pairs.select("u", "v", "u_size", "u_bands", "v_size", "v_bands").mapInArrow(run, "u bigint, v bigint")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sizes, parity bits and sketches do not speak against the limit."""
    sides = classes.select("node", "n_shingles", "bands", "bits")
    names = ("size", "bands", "bits")
    for side in ("u", "v"):
        pairs = pairs.join(sides.toDF(side, *[f"{side}_{name}" for name in names]), side)
    close = _close(F.col("u_size"), F.col("u_bits"), F.col("v_size"), F.col("v_bits"), percent)
    return _probable(pairs.filter(_fitting(F.col("u_size"), F.col("v_size"), percent) & close), percent)


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets reach the limit."""
    sides = texts.select("row", "text")
    # The same plan at every size: texts are dealt out by row, never their pairs broadcast.
    joined = pairs.join(sides.toDF("u", "u_text").hint("merge"), "u").join(sides.toDF("v", "v_text").hint("merge"), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: tuple[int | None, set] = (None, set())
        for batch in batches:
            good = []
            for u, left, right in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if kept[0] != u:
                    kept = (u, shingle_set(left.as_py(), size))
                other = shingle_set(right.as_py(), size)
                common = len(kept[1] & other)
                good.append(100 * common >= percent * (len(kept[1]) + len(other) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(good, pa.bool_()))

    return joined.select("u", "v", "u_text", "v_text").mapInArrow(run, "u bigint, v bigint")


def _bucket_pairs(members: DataFrame, turn: int) -> DataFrame:
    """(hub, member) of all buckets with several components; the hub is the class with most copies, then by
    a hash that changes with the turn."""
    order = F.struct(
        (-F.col("copies") if turn == 0 else F.lit(0)).alias("few"),
        F.xxhash64("node", F.lit(turn)).alias("chance"), "node", "root",
    )
    hubs = (
        members.groupBy("bucket")
        .agg(F.min(order).alias("hub"), F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select(F.col("bucket").alias("b"), F.col("hub.node").alias("hub"), F.col("hub.root").alias("hub_root"))
    )
    hubs = stored(hubs, "hubs")
    joined = members.join(hubs, F.col("bucket") == F.col("b")).filter("root <> hub_root")
    return joined.select(F.least("hub", "node").alias("u"), F.greatest("hub", "node").alias("v")).distinct()


def _all_pairs(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs of a bucket's members of different components that sizes, parity bits and sketches let through. The sketches come to
    the buckets, so that only such pairs leave the join; unlinked pairs far below the limit never become rows."""
    # Classes without parity bits are compared by size and sketch alone.
    bits = [c for c in classes.columns if c == "bits"]
    sides = classes.select("node", F.col("n_shingles").alias("size"), "bands", *bits)
    known = members.select("bucket", "band", "node", "root").join(sides, "node")
    other = known.toDF(*[f"v_{c}" for c in known.columns])
    differences = _differences(F.col("bands"), F.col("v_bands"))
    enough = _equal_registers(differences) >= int((percent / 100 - EQUAL_MARGIN) * REGISTERS)
    # A pair of different components shares only buckets that are looked at here; it leaves the first of them.
    once = _first_band(differences) == F.col("band")
    meeting = (
        (F.col("bucket") == F.col("v_bucket"))
        & (F.col("node") < F.col("v_node"))
        & (F.col("root") != F.col("v_root"))
        & _fitting(F.col("size"), F.col("v_size"), percent)
        & (_close(F.col("size"), F.col("bits"), F.col("v_size"), F.col("v_bits"), percent) if bits else F.lit(True))
        & enough
        & once
    )
    both = known.join(other, meeting)
    named = both.select(
        F.col("node").alias("u"), F.col("v_node").alias("v"), F.col("size").alias("u_size"), F.col("bands").alias("u_bands"),
        "v_size", "v_bands",
    )
    return _probable(named, percent)


def near_duplicates(rows: DataFrame, size: int, percent: int = LEAST_PERCENT) -> DataFrame:
    """Per row of ``rows`` (row, id, text; ``row`` numbers the rows of a stored table): row, id, n_shingles,
    component_id (least id of the component), keeper (the row that stands for the component)."""
    sketches = stored(_sketches(rows, size), "sketches")
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row"))
    classes = stored(
        sketches.filter("digest IS NOT NULL")
        .groupBy("digest")
        .agg(
            F.min("row").alias("node"), first.alias("first"), F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"),
            F.first("bits").alias("bits"),
        ),
        "classes",
    )
    buckets = classes.select("node", "copies", F.posexplode(band_keys(F.col("bands"))).alias("band", "bucket"))
    # Only buckets with several classes are kept.
    shared = stored(
        buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("bucket").alias("b")),
        "shared",
    )
    members = stored(
        buckets.join(shared, F.col("bucket") == F.col("b")).select(
            "bucket", "band", "node", "copies", F.col("node").alias("root")
        ),
        "members",
    )
    wanted = members.select("node").distinct()
    texts = stored(
        rows.select("row", "text").join(wanted.hint("merge"), F.col("row") == F.col("node"), "left_semi"), "texts"
    )
    n_classes = classes.count()
    roots: DataFrame | None = None
    active = members.filter(F.col("band") < FIRST_BANDS)
    idle = False
    for turn in range(HUB_ROUNDS + 1):
        # Pairs of different components that remain if every bucket were paired out.
        parts = active.groupBy("bucket", "root").agg(F.count(F.lit(1)).cast("double").alias("m"))
        sizes = parts.groupBy("bucket").agg(F.sum("m").alias("n"), F.sum(F.col("m") * F.col("m")).alias("own"))
        remaining = sizes.agg(F.sum(F.col("n") * F.col("n") - F.col("own")) / 2).first()[0] or 0.0
        if turn and not remaining:
            break
        last = turn > 0 and (idle or remaining <= PAIRS_PER_CLASS * n_classes or turn == HUB_ROUNDS)
        if last:
            likely = stored(_all_pairs(active, classes, percent), "likely")
        else:
            likely = stored(_likely(_bucket_pairs(active, turn), classes, percent), "likely")
        found = stored(_verified(likely, texts, size, percent), "links")
        discard(likely)
        fruitless = found.isEmpty()
        if not fruitless:
            # The stars so far stand for all links found before.
            stars = None if roots is None else roots.select(F.col("node").alias("u"), F.col("root").alias("v"))
            roots = components(found if stars is None else stars.union(found))
        if last:
            break
        idle = fruitless and turn > 0
        if fruitless and turn > 0:
            continue
        labelled = members
        if roots is not None:
            joined = members.join(roots.withColumnRenamed("root", "new_root"), "node", "left")
            labelled = joined.select("bucket", "band", "node", "copies", F.coalesce("new_root", "node").alias("root"))
        labelled = stored(labelled, "labelled")
        open_ = stored(
            labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
            .filter("low <> high").select(F.col("bucket").alias("b")),
            "open",
        )
        active = stored(labelled.join(open_, F.col("bucket") == F.col("b"), "left_semi"), "active")
        discard(labelled, open_)
    discard(texts, shared, members)
    placed = classes.select("digest", "node", "first")
    if roots is None:
        named = placed.withColumn("root", F.col("node"))
    else:
        named = placed.join(roots, "node", "left").select(
            "digest", "first", F.coalesce("root", "node").alias("root")
        )
    named = stored(named.select("digest", "first", "root"), "named")
    least = stored(named.groupBy(F.col("root").alias("r")).agg(F.min("first").alias("least")), "least")
    by_class = stored(
        named.join(least, F.col("root") == F.col("r")).select(F.col("digest").alias("class"), "least"), "by_class"
    )
    discard(named, least, classes)
    full = sketches.filter("digest IS NOT NULL").join(by_class, F.col("digest") == F.col("class"))
    empty = sketches.filter("digest IS NULL")
    return full.select(
        "row", "id", "n_shingles", F.col("least.id").alias("component_id"), F.col("least.row").alias("keeper")
    ).unionByName(
        empty.select("row", "id", "n_shingles", F.col("id").alias("component_id"), F.col("row").alias("keeper"))
    )


def duplicate_groups(
    docs: DataFrame, size: int = 5, percent: int = LEAST_PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: its id, n_shingles, component_id, kept."""
    rows = stored(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("id"), F.col(text).alias("text")),
        "rows",
    )
    found = near_duplicates(rows, size, percent)
    return found.select(
        F.col("id").alias(doc_id), "n_shingles", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(
    docs: DataFrame, size: int = 5, percent: int = LEAST_PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents without near duplicates: of each group the one with the least id stays."""
    everything = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), everything.alias("doc")), "rows")
    named = rows.select("row", F.col(f"doc.`{doc_id}`").alias("id"), F.col(f"doc.`{text}`").alias("text"))
    keepers = near_duplicates(named, size, percent).filter(F.col("row") == F.col("keeper")).select("keeper")
    return rows.join(keepers, F.col("row") == F.col("keeper"), "left_semi").select("doc.*")
