"""A Merkle manifest of a dataset: one tree per source, a tree over the sources' roots, and proofs.

Every row of a table is a leaf. The leaves of a source ascend by id; while several nodes remain, every 16
consecutive ones become their hash, and the node that remains is the source's root. The roots of the sources,
in order, make the top tree in the same way.

*Postorder append log.* The nodes of a tree are numbered in the order in which they would be finished if its leaves
were appended one after the other: each inner node right behind its last child. A complete subtree is then one
unbroken stretch of the log, and positions need no index: leaf i stands behind the i leaves and the
i//16 + i//256 + ... inner nodes finished before it, and a node stands as many places behind its last leaf as it has
levels (:func:`position`). Nodes above the last leaf are finished when the log is closed, by the same formula.

*Aligned builders.* A builder takes an aligned block of ``16 ** BUILD_LEVELS`` leaves and writes its subtree's stretch
of the log in that order; the roots of the blocks are the leaves of the next round. No task ever holds more than a block,
however large a source is, and there are as many rounds as the largest tree has levels, divided by ``BUILD_LEVELS``.

*Proofs.* The siblings of a node are addressed by their positions in the log. The inner nodes of a block are shared by its
leaves, so a block reads its own stretch once and the siblings above it, at most 15 a level.

Leaves get their numbers by a range sort of digests, ids and sources (texts are hashed where they are read and do not
travel): counts per sorted part and source, summed up, and the place within the part.

Defined cases: any NULL counts as ``-`` in a leaf; rows without an id come first within their source, NULL is a source of its
own and the first; repeated ids are leaves of their own, in the order of their digests; an empty table has no rows. Only
the named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskbook.llm.common import stored

FAN_BITS = 4
FAN_IN = 1 << FAN_BITS
BUILD_LEVELS = 3  # of a builder: 16 ** 3 = 4096 leaves in a block
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TAMPER_EVERY = 5

LOG = "tree string, level int, index bigint, position bigint, digest binary"


def joined_hash(parts: Sequence[bytes]) -> bytes:
    """The digest of digests: sha256 of their hex texts in a row."""
    return hashlib.sha256("".join([p.hex() for p in parts]).encode()).digest()


def levels_of(size: int) -> int:
    """Levels above the leaves of a tree of ``size`` leaves."""
    levels = 0
    while size > 1:
        size = -(-size // FAN_IN)
        levels += 1
    return levels


def level_size(size: int, level: int) -> int:
    return -(-size // FAN_IN**level)


def position(level: int, index: int, size: int) -> int:
    """Place in the log of a node of a tree of ``size`` leaves, counted from 0."""
    last = min((index + 1) * FAN_IN**level, size) - 1
    at = last + level
    while last:
        last //= FAN_IN
        at += last
    return at


def siblings(level: int, index: int, size: int) -> list[int]:
    """Indexes of the other nodes of a node's run, left to right."""
    first = index - index % FAN_IN
    return [i for i in range(first, min(first + FAN_IN, level_size(size, level))) if i != index]


# --- leaves ---------------------------------------------------------------------------------------


def measured_value(value: Column) -> Column:
    """``-`` for NULL, else the length in bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[measured_value(v) for v in values]).cast("binary"), 256))


def numbered(leaves: DataFrame) -> DataFrame:
    """Adds index (from 0, per tree in the order of id and digest) and size (leaves of the tree) to (tree, id, digest,
    others). The rows are sorted by range; only counts per part and tree are added up."""
    order = ["tree", "id", "digest"]
    place = F.monotonically_increasing_id()
    ranged = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place)
    rows = stored(ranged.withColumn("part", F.shiftright("place", 33)), "sorted")
    parts = rows.groupBy("tree", "part").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    by_tree = Window.partitionBy("tree")
    before = F.sum("n").over(by_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select(
        F.col("tree").alias("t"), F.col("part").alias("p"), "start",
        F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(by_tree).alias("size"),
    )
    here = F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p"))
    index = F.col("place") - F.col("start") + F.col("before")
    return rows.join(starts, here).select(*leaves.columns, index.alias("index"), "size")


# --- building -------------------------------------------------------------------------------------


def _block(level: int | Column) -> Column:
    """The number of the builder's block that nodes of a level below ``BUILD_LEVELS`` lie in."""
    up = FAN_BITS * (BUILD_LEVELS - (F.lit(level) if isinstance(level, int) else level))
    return F.call_function("shiftright", F.col("index"), up.cast("int"))


def _built(nodes: DataFrame, base: int) -> DataFrame:
    """The log rows above level ``base`` that builders finish from its nodes (tree, index, size, digest)."""

    def build(block: pa.Table) -> pa.Table:
        tree, size = block["tree"][0].as_py(), block["size"][0].as_py()
        height = levels_of(size)
        now = sorted(zip(block["index"].to_pylist(), block["digest"].to_pylist()))
        out: list[tuple[int, int, int, bytes]] = []
        for level in range(base + 1, min(base + BUILD_LEVELS, height) + 1):
            above = []
            for at in range(0, len(now), FAN_IN):
                run = now[at : at + FAN_IN]
                index = run[0][0] // FAN_IN
                above.append((index, joined_hash([digest for _, digest in run])))
                out.append((position(level, index, size), level, *above[-1]))
            now = above
        out.sort()  # the order in which the nodes are finished
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table(
            {
                "tree": pa.array([tree] * len(out), pa.string()),
                "level": pa.array(columns[1], pa.int32()),
                "index": pa.array(columns[2], pa.int64()),
                "position": pa.array(columns[0], pa.int64()),
                "digest": pa.array(columns[3], pa.binary()),
                "size": pa.array([size] * len(out), pa.int64()),
            }
        )

    blocks = nodes.select("tree", "index", "size", "digest", _block(0).alias("block"))
    return blocks.groupBy("tree", "block").applyInArrow(build, f"{LOG}, size bigint")


def _leaf_position(index: Column, levels: int) -> Column:
    """:func:`position` of leaves in trees of at most ``levels`` levels."""
    at = index
    for level in range(1, levels + 1):
        at = at + F.shiftright(index, FAN_BITS * level)
    return at


def build_log(leaves: DataFrame) -> DataFrame:
    """The nodes of all trees of (tree, index, size, digest): tree, level, index, position, digest, size; a stored
    table, written in one part for each round of building."""
    largest = leaves.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    height = levels_of(largest)
    own = leaves.select(
        "tree", F.lit(0).alias("level"), "index", _leaf_position(F.col("index"), height).alias("position"),
        "digest", "size",
    )
    rounds, now = [own], leaves
    for base in range(0, height, BUILD_LEVELS):
        built = stored(_built(now, base), "nodes")
        rounds.append(built)
        now = built.filter(F.col("level") == base + BUILD_LEVELS)
    log = rounds[0]
    for part in rounds[1:]:
        log = log.unionByName(part)
    return log


def _height(size: Column) -> Column:
    """:func:`levels_of` for any count."""
    return sum((F.when(size > F.lit(1 << FAN_BITS * level), 1).otherwise(0) for level in range(16)), F.lit(0))


def roots(log: DataFrame) -> DataFrame:
    """(tree, size, digest): the last node of each tree's log."""
    return log.filter(F.col("level") == _height(F.col("size"))).select("tree", "size", "digest")


# --- proofs ---------------------------------------------------------------------------------------


def _above(nodes: DataFrame, log: DataFrame, base: int) -> DataFrame:
    """For nodes (tree, index, size) of level ``base``: path, the siblings from there up to the root, each with its level
    and index, found in the log by their positions."""

    def address(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            trees, indexes, wanted = [], [], []
            for tree, index, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                at = index
                for level in range(base, levels_of(size)):
                    for other in siblings(level, at, size):
                        trees.append(tree)
                        indexes.append(index)
                        wanted.append(position(level, other, size))
                    at //= FAN_IN
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.string()), pa.array(indexes, pa.int64()), pa.array(wanted, pa.int64())],
                ["tree", "node", "wanted"],
            )

    asked = nodes.select("tree", "index", "size").mapInArrow(address, "tree string, node bigint, wanted bigint")
    upper = log.filter(F.col("level") >= base).select(F.col("tree").alias("t"), "position", "level", "index", "digest")
    found = asked.join(upper, F.col("tree").eqNullSafe(F.col("t")) & (F.col("wanted") == F.col("position")))
    paths = found.groupBy("tree", "node").agg(F.collect_list(F.struct("level", "index", "digest")).alias("path"))
    matched = F.col("tree").eqNullSafe(F.col("t")) & (F.col("index") == F.col("node"))
    return nodes.join(paths.withColumnRenamed("tree", "t"), matched, "left").select("tree", "index", "size", "path")


def _fold(digest: bytes, path: Sequence[tuple[int, Sequence[bytes]]]) -> bytes:
    """From a node's digest to the root: per level the node's place in its run, and its siblings."""
    for place, others in path:
        digest = joined_hash([*others[:place], digest, *others[place:]])
    return digest


def _grouped(siblings_above: Sequence[dict] | None, index: int, base: int, size: int) -> list[tuple[int, list[bytes]]]:
    """The siblings of a path level by level, each with the place of the node between them."""
    by_level: dict[int, list[tuple[int, bytes]]] = {}
    for s in siblings_above or ():
        by_level.setdefault(s["level"], []).append((s["index"], s["digest"]))
    path = []
    for level in range(base, levels_of(size)):
        path.append((index % FAN_IN, [d for _, d in sorted(by_level.get(level, []))]))
        index //= FAN_IN
    return path


def proofs(leaves: DataFrame, log: DataFrame, top_paths: DataFrame) -> DataFrame:
    """For leaves (tree, id, index, size, digest, shown): id, leaf, proof_sha256 and folded, the root that follows from ``shown``.

    ``top_paths`` has the path of each tree's root in the top tree: tree, place (its number), count (of trees), path.
    """
    blocks = leaves.select("tree", _block(0).alias("index"), "size").distinct()
    upper = _above(blocks, log, BUILD_LEVELS)
    tops = top_paths.select(F.col("tree").alias("t"), "place", "count", F.col("path").alias("top_path"), "subroot")
    heads = upper.join(tops, F.col("tree").eqNullSafe(F.col("t"))).select(
        F.col("tree").alias("in_tree"), F.col("index").alias("in_block"), "path", "place", "count", "top_path", "subroot"
    )
    inside = log.filter(F.col("level").between(1, BUILD_LEVELS - 1)).withColumn("block", _block(F.col("level")))
    own = leaves.select(
        "tree", _block(0).alias("block"), F.lit(0).alias("level"), "index", "digest", "size", "id", "shown"
    )
    stretch = own.unionByName(inside.select("tree", "block", "level", "index", "digest", "size"), allowMissingColumns=True)

    def prove(block: pa.Table, head: pa.Table) -> pa.Table:
        names = ["id", "leaf", "subroot", "proof_sha256", "folded"]
        head = head.to_pylist()[0]
        levels, indexes, digests = (block[c].to_pylist() for c in ("level", "index", "digest"))
        size = block["size"][0].as_py()
        nodes = {(level, index): digest for level, index, digest in zip(levels, indexes, digests)}
        first = head["in_block"]
        above = _grouped(head["path"], first, BUILD_LEVELS, size) + _grouped(head["top_path"], head["place"], 0, head["count"])
        shared = "".join([d.hex() for _, others in above for d in others])
        columns: list[list] = [[] for _ in names]
        for level, index, digest, key, shown in zip(levels, indexes, digests, block["id"].to_pylist(), block["shown"].to_pylist()):
            if level:
                continue
            path, at = [], index
            for up in range(min(BUILD_LEVELS, levels_of(size))):
                path.append((at % FAN_IN, [nodes[(up, i)] for i in siblings(up, at, size)]))
                at //= FAN_IN
            proof = "".join([d.hex() for _, others in path for d in others]) + shared
            values = (key, digest, head["subroot"], hashlib.sha256(proof.encode()).digest(), _fold(shown, path + above))
            for column, value in zip(columns, values):
                column.append(value)
        arrays = [pa.array(columns[0], block["id"].type), *(pa.array(c, pa.binary()) for c in columns[1:])]
        return pa.table(dict(zip(names, arrays)))

    kind = leaves.schema["id"].dataType.simpleString()
    return (
        stretch.groupBy("tree", "block")
        .cogroup(heads.groupBy("in_tree", "in_block"))
        .applyInArrow(prove, f"id {kind}, leaf binary, subroot binary, proof_sha256 binary, folded binary")
    )


def top_tree(subroots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (tree, digest): the log of the tree over all trees, NULL first, and per tree its place, the count and the path."""
    named = subroots.select(F.lit("").alias("tree"), F.struct(F.col("tree").isNotNull().alias("named"), "tree").alias("id"), "digest")
    leaves = stored(numbered(named), "top")
    log = stored(build_log(leaves.select("tree", "index", "size", "digest")), "top-log")
    paths = _above(leaves.select("tree", "index", "size"), log, 0).select(F.col("index").alias("i"), "path")
    places = leaves.join(paths, F.col("index") == F.col("i")).select(
        F.col("id.tree").alias("tree"), F.col("index").alias("place"), F.col("size").alias("count"), "path",
        F.col("digest").alias("subroot"),
    )
    return log, places


def manifest(docs: DataFrame, columns: Sequence[str], doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Per row: its id, leaf, subroot, root, proof_sha256, folded_root, verified.

    The leaf hashes ``columns`` in their order. As a check of the proofs, every fifth row, by a hash of its id, is shown to
    the verifier with A to Z of its text in lower case.
    """
    values = [F.col(c) for c in columns]
    low = F.translate(F.col(text), UPPER, LOWER)
    changed = [low if c == text else F.col(c) for c in columns]
    tampered = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(TAMPER_EVERY)) == 0
    rows = stored(
        docs.select(
            F.col(source).cast("string").alias("tree"), F.col(doc_id).alias("id"), leaf_digest(values).alias("digest"),
            F.when(tampered, leaf_digest(changed)).alias("other"),
        ),
        "leaves",
    )
    leaves = stored(numbered(rows).withColumn("shown", F.coalesce("other", "digest")).drop("other"), "numbered")
    log = build_log(leaves.select("tree", "index", "size", "digest"))
    subroots = stored(roots(log).select("tree", "digest"), "subroots")
    top_log, places = top_tree(subroots)
    root = roots(top_log).select("digest").scalar()
    found = proofs(leaves, log, places).withColumn("root", root)

    def text_of(name: str) -> Column:
        return F.lower(F.hex(name))

    return found.select(
        F.col("id").alias(doc_id), text_of("leaf").alias("leaf"), text_of("subroot").alias("subroot"),
        text_of("root").alias("root"), text_of("proof_sha256").alias("proof_sha256"),
        text_of("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


def write_log(docs: DataFrame, columns: Sequence[str], path: str, doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """Write the log of every source's tree as Parquet, sorted by tree and position, and give it back."""
    rows = stored(
        docs.select(
            F.col(source).cast("string").alias("tree"), F.col(doc_id).alias("id"), leaf_digest([F.col(c) for c in columns]).alias("digest")
        ),
        "leaves",
    )
    leaves = stored(numbered(rows), "numbered")
    log = build_log(leaves.select("tree", "index", "size", "digest"))
    log.repartitionByRange("tree", "position").sortWithinPartitions("tree", "position").write.parquet(path)
    return docs.sparkSession.read.schema(log.schema).parquet(path)
