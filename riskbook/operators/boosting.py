"""Boosted trees of many settings and folds grown side by side: one pass over the rows serves a level of all their trees.

The steps are the library's: thresholds from a sample of the training rows, bins of at most ``maxBins`` values, levels one after
the other, the split of most gain over all slots, leaves that hold the mean of what is left of the logistic loss. What differs is
how rows are kept: as the numbers of their filled bins (some 25 to 50 bytes a row instead of the library's 600), with the score
that every run has reached so far. Of two siblings only the smaller is counted; the other is what is left of their parent.

The driver holds thresholds, trees and the counts of one level by bin for each run, whatever the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskbook.sources.session import remove_at_exit, remove_now, shared_folder

# The functions that run inside tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 10_000  # rows that thresholds are taken from, as in the library (or maxBins squared)
MANY_ROWS = 1_000_000  # below, the library's own fit takes no longer
_BLOCK = "fold binary, label binary, numbers binary, flags binary, scores binary"
_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


# --- slots and their bins ------------------------------------------------------------------------------


def arities(rows: DataFrame, features: str, size: int) -> np.ndarray:
    """Values of each slot that holds a category, 0 for a number, from the vector's metadata as the library reads it."""
    found = np.zeros(size, int)
    groups = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    for kind, attributes in groups.items():
        for a in attributes:
            if kind == "binary":
                found[a["idx"]] = 2
            elif kind == "nominal":
                found[a["idx"]] = a["num_vals"] if "num_vals" in a else len(a["vals"])
    return found


def thresholds(values: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` thresholds between distinct values, so that about equally many values lie between any two."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) <= most:
        return middles
    stride = len(values) / (most + 1)
    chosen, target, upto = [], stride, np.cumsum(counts).tolist()
    for i, (before, after) in enumerate(zip(upto, upto[1:])):
        if abs(before - target) < abs(after - target):
            chosen.append(i)
            target += stride
    return middles[chosen]


def sampled(rows: DataFrame, features: str, folds: int, bins: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Folds and vectors of a sample as large as the library's for each fold's training rows."""
    total = rows.count()
    wanted = max(bins * bins, SAMPLE_ROWS) * folds / max(folds - 1, 1)
    chosen = rows if wanted >= total else rows.sample(False, wanted / total, seed)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, vectors = batch.columns
            parts = [fold.to_numpy().astype(np.int32), vectors.flatten().to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], ["fold", "slots"])

    columns = [F.col("fold").cast("int").alias("fold"), vector_to_array(features).alias("slots")]
    packed = chosen.select(*columns).mapInArrow(pack, "fold binary, slots binary")
    found = packed.agg(F.collect_list(F.struct("fold", "slots"))).first()[0]
    fold = np.concatenate([np.frombuffer(p["fold"], np.int32) for p in found])
    return fold, np.concatenate([np.frombuffer(p["slots"]) for p in found]).reshape(len(fold), -1)


class Layout:
    """How slots become bins. Tasks keep a row as the fine codes of its numbers, cut at the thresholds of all folds, and as the
    list of its filled flags (slots of two values); a run adds up the bins of its own fold. What is left of a node is without
    the flag."""

    def __init__(self, arity: np.ndarray, fold: np.ndarray, sample: np.ndarray, left_out: Sequence[int], bins: int):
        self.arity, self.left_out = arity, list(left_out)
        self.numbers, self.flags = np.flatnonzero(arity != 2), np.flatnonzero(arity == 2)
        none = np.empty(0)
        self.own = [
            [none if arity[j] else thresholds(sample[fold != k, j], bins - 1) for j in range(len(arity))] for k in self.left_out
        ]
        self.cuts = [np.unique(np.concatenate([own[j] for own in self.own])) for j in range(len(arity))]
        self.codes = np.where(arity > 0, arity, [len(c) + 1 for c in self.cuts])
        self.most_codes = int(self.codes.max())
        self.bins = np.where(arity > 0, arity, [max(len(own[j]) for own in self.own) + 1 for j in range(len(arity))])
        self.starts = 1 + np.append(0, np.cumsum(self.bins))  # bin 0 fills up short rows
        self.width = int(self.starts[-1])
        # By fold: the bin of each fine code of each slot.
        self.bin_of = [
            [
                np.arange(arity[j]) if arity[j] else np.append(0, np.searchsorted(own[j], self.cuts[j], "right"))
                for j in range(len(arity))
            ]
            for own in self.own
        ]
        self.number_bins = [[(self.starts[j] + found[j]).astype(np.int32) for j in self.numbers] for found in self.bin_of]
        self.flag_bins = np.append(0, self.starts[self.flags] + 1).astype(np.int32)
        self.code_kind = np.min_scalar_type(self.most_codes)
        self.flag_kind = np.min_scalar_type(len(self.flags) + 1)

    def columns(self, slots: Sequence[int], numbers: np.ndarray, flags: np.ndarray) -> np.ndarray:
        """The codes of some slots, one after the other, behind a column of zeros."""
        codes = np.zeros((1 + len(slots), numbers.shape[1]), self.code_kind)
        for at, j in enumerate(slots, 1):
            if self.arity[j] == 2:
                codes[at] = np.logical_or.reduce(flags == np.searchsorted(self.flags, j) + 1, axis=0)
            else:
                codes[at] = numbers[np.searchsorted(self.numbers, j)]
        return codes.ravel()


def blocks(rows: DataFrame, features: str, layout: Layout) -> DataFrame:
    """The rows' numbers and flags in blocks, column by column, with labels of -1 and 1 and no scores yet."""
    size = len(layout.arity)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, label, vectors = batch.columns
            if not len(fold):
                continue
            dense = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(fold), size)
            numbers = np.empty((len(layout.numbers), len(fold)), layout.code_kind)
            for at, j in enumerate(layout.numbers):
                numbers[at] = dense[:, j] if layout.arity[j] else np.searchsorted(layout.cuts[j], dense[:, j])
            at, flag = np.nonzero(dense[:, layout.flags])
            filled = np.bincount(at, minlength=len(fold))
            flags = np.zeros((int(filled.max()), len(fold)), layout.flag_kind)
            flags[np.arange(len(at)) - np.repeat(np.cumsum(filled) - filled, filled), at] = flag + 1
            parts = [fold.to_numpy().astype(np.int32), (2 * label.to_numpy() - 1).astype(np.int8), numbers, flags, np.empty(0)]
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], _NAMES)

    columns = [F.col("fold").cast("int").alias("fold"), F.col("label").cast("double").alias("label")]
    return rows.select(*columns, vector_to_array(features).alias("slots")).mapInArrow(pack, _BLOCK)


def _unpacked(batches: Iterator[pa.RecordBatch], layout: Layout) -> Iterator[tuple]:
    """Fold, label, numbers, flags and scores by run of each block, and the block as it came."""
    kinds = (np.int32, np.int8, layout.code_kind, layout.flag_kind, float)
    for batch in batches:
        for i in range(batch.num_rows):
            fold, label, numbers, flags, scores = (np.frombuffer(c[i].as_buffer(), k) for c, k in zip(batch.columns, kinds))
            n = len(fold)
            numbers, flags = numbers.reshape(len(layout.numbers), n), flags.reshape(-1, n)
            yield fold, label.astype(float), numbers, flags, scores.reshape(-1, n) if len(scores) else None, batch.slice(i, 1)


# --- trees ---------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes by number: the slot that splits them and, for each of its codes, the next node (a leaf is its own)."""

    codes: int
    nexts: list[np.ndarray] = field(default_factory=list)
    splits: list[tuple | None] = field(default_factory=list)
    gains: list[float] = field(default_factory=list)
    stats: list[np.ndarray] = field(default_factory=list)  # rows, sum, sum of squares of what a node was to fit

    def add(self, stats: np.ndarray) -> int:
        number = len(self.splits)
        self.nexts.append(np.full(self.codes, number))
        self.splits.append(None)
        self.gains.append(0.0)
        self.stats.append(stats)
        return number

    def values(self) -> np.ndarray:
        return np.array([s[1] / s[0] if s[0] else 0.0 for s in self.stats])

    def used(self) -> set[int]:
        return {split[0] for split in self.splits if split}

    def table(self, columns: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Of every node the column of its slot (0 for a leaf), and the next nodes by code."""
        place = {j: at for at, j in enumerate(columns, 1)}
        return np.array([place[s[0]] if s else 0 for s in self.splits]), np.concatenate(self.nexts)


def _reached(table: tuple, depth: int, codes: np.ndarray, rows: np.ndarray, most_codes: int) -> np.ndarray:
    """The nodes where rows arrive."""
    columns, nexts = table
    if not depth:
        return np.zeros(len(rows), np.int64)
    begins = columns * len(rows)
    node = np.take(nexts, np.take(codes, begins[0] + rows))
    for _ in range(depth - 1):
        node = np.take(nexts, node * most_codes + np.take(codes, np.take(begins, node) + rows))
    return node


@dataclass
class Run:
    """A fold left out (none: -1) and a step size: the trees so far and the open nodes of the one that grows."""

    place: int  # of the fold in the layout
    step: float
    trees: list[Tree] = field(default_factory=list)
    open: list[int] = field(default_factory=list)
    built: list[int] = field(default_factory=list)  # of each pair of open nodes, the one that is counted by bin
    parents: tuple | None = None  # their parents' counts, by bin and as a whole
    level: int = 0

    def begin(self, codes: int) -> None:
        tree = Tree(codes)
        self.trees.append(tree)
        self.open, self.parents, self.level = [tree.add(np.zeros(3))], None, 0
        self.built = self.open

    def weight(self, number: int) -> float:
        return self.step if number else 1.0


def _numbers(nodes: int, chosen: Sequence[int]) -> np.ndarray:
    found = np.full(nodes, -1)
    found[chosen] = np.arange(len(chosen))
    return found


def counted(packed: DataFrame, layout: Layout, runs: Sequence[Run], kinds: int) -> list[tuple[np.ndarray, np.ndarray] | None]:
    """For every run with open nodes, counts, sums and (of three kinds) squares of its built nodes by bin, and all three of
    them as a whole: one pass."""
    active = [i for i, run in enumerate(runs) if run.open]
    used = sorted(set().union(*[runs[i].trees[-1].used() for i in active]))
    jobs: dict[int, list] = {}
    for i in active:
        run, tree = runs[i], runs[i].trees[-1]
        built = _numbers(len(tree.splits), run.built)
        job = (i, len(run.trees) - 1, run.level, tree.table(used), built, len(run.built))
        jobs.setdefault(run.place, []).append(job)
    width = layout.width

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = {job[0]: np.zeros((kinds, job[5] * width)) for found in jobs.values() for job in found}
        sums = {job[0]: np.zeros((3, job[5])) for found in jobs.values() for job in found}
        for fold, label, numbers, flags, scores, _ in _unpacked(batches, layout):
            codes, rows = layout.columns(used, numbers, flags), np.arange(len(fold))
            own = np.empty((len(numbers) + len(flags), len(fold)), np.int32)
            np.take(layout.flag_bins, flags, out=own[len(numbers) :], mode="clip")
            for place, found in jobs.items():
                for k, lookup in enumerate(layout.number_bins[place]):
                    np.take(lookup, numbers[k], out=own[k], mode="clip")
                held = np.flatnonzero(fold == layout.left_out[place])
                for i, number, level, table, built, nodes in found:
                    among = np.take(built, _reached(table, level, codes, rows, layout.most_codes))
                    among[held] = -1
                    seen = np.flatnonzero(among >= 0)
                    among, pull = among[seen], label[seen]
                    if number:
                        pull = 4 * pull / (1 + np.exp(2 * pull * scores[i][seen]))
                    index = (np.take(own, seen, axis=1, mode="clip") + among * width).ravel()
                    for k, values in enumerate((None, pull, pull * pull)):
                        sums[i][k] += np.bincount(among, values, nodes)
                        if k < kinds:
                            every = None if values is None else np.tile(values, len(own))
                            bins[i][k] += np.bincount(index, every, nodes * width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(bins), pa.int32()), pa.array([np.append(bins[i], sums[i]).tobytes() for i in bins], pa.binary())],
            ["run", "sums"],
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for run, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums = np.frombuffer(part.as_buffer())
                totals[run] = totals[run] + sums if run in totals else sums
        if totals:
            rows = [pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(rows, ["run", "sums"])

    columns = "run int, sums binary"
    tasks = min(len(active), packed.sparkSession.sparkContext.defaultParallelism)
    merged = packed.mapInArrow(add, columns).repartition(tasks, "run").mapInArrow(merge, columns)
    answers = {r["run"]: np.frombuffer(r["sums"]) for r in merged.agg(F.collect_list(F.struct("run", "sums"))).first()[0]}
    found: list = [None] * len(runs)
    for i in active:
        at = kinds * len(runs[i].built) * width
        by_bin = np.moveaxis(answers[i][:at].reshape(kinds, -1, width), 0, 2)
        found[i] = (by_bin, answers[i][at:].reshape(3, -1).T)
    return found


def _filled(by_bin: np.ndarray, totals: np.ndarray, layout: Layout) -> np.ndarray:
    """With the rows that lack a flag: what those with it leave of the node."""
    by_bin = by_bin.copy()
    without = layout.starts[layout.flags]
    rest = totals[:, None, : by_bin.shape[2]] - by_bin[:, without + 1]
    rest[rest[..., 0] <= 0] = 0.0
    by_bin[:, without] = rest
    return by_bin


def _first_of_most(gains: np.ndarray, axis: int) -> np.ndarray:
    """Where the first of the largest gains is; those that differ by rounding only are equal."""
    most = gains.max(axis=axis, keepdims=True)
    return (gains >= most - 1e-11 * np.abs(np.where(np.isfinite(most), most, 0.0))).argmax(axis=axis)


def _best(by_bin: np.ndarray, totals: np.ndarray, layout: Layout) -> tuple:
    """For every node the split of most gain: gain, slot, the last bin that goes left, what is left, and the order of each category's values."""
    nodes, size = len(by_bin), len(layout.arity)
    gains, places = np.full((nodes, size), -np.inf), np.zeros((nodes, size), int)
    lefts, orders = np.zeros((nodes, size, by_bin.shape[2])), {}
    n, s = totals[:, 0, None, None], totals[:, 1, None, None]
    for kind, bins in {(bool(a), int(b)) for a, b in zip(layout.arity, layout.bins) if b > 1}:
        slots = np.flatnonzero((layout.bins == bins) & ((layout.arity > 0) == kind))
        held = by_bin[:, layout.starts[slots][:, None] + np.arange(bins)]
        if kind:  # values of a category in the order of their means, empty ones last
            mean = np.divide(held[..., 1], held[..., 0], out=np.full(held.shape[:-1], np.inf), where=held[..., 0] > 0)
            order = np.argsort(mean, axis=2, kind="stable")
            held = np.take_along_axis(held, order[..., None], 2)
            orders.update({int(j): order[:, i] for i, j in enumerate(slots)})
        left = np.cumsum(held, axis=2)[:, :, :-1]
        nl, sl = left[..., 0], left[..., 1]
        nr, sr = n - nl, s - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where((nl > 0) & (nr > 0), (sl * sl / nl + sr * sr / nr - s * s / n) / n, -np.inf)
        best = _first_of_most(gain, 2)[..., None]
        gains[:, slots], places[:, slots] = np.take_along_axis(gain, best, 2)[..., 0], best[..., 0]
        lefts[:, slots] = np.take_along_axis(left, best[..., None], 2)[:, :, 0]
    slot = _first_of_most(gains, 1)
    at = np.arange(nodes)
    return gains[at, slot], slot, places[at, slot], lefts[at, slot], orders


def grown(run: Run, layout: Layout, by_bin: np.ndarray, totals: np.ndarray, depth: int) -> None:
    """Splits the open nodes of a run's tree and opens what they are split into."""
    tree = run.trees[-1]
    if run.parents is None:
        whole = _filled(by_bin, totals, layout)
    else:
        # Open nodes come in pairs of siblings, one of which is built.
        chosen = _numbers(len(tree.splits), run.built)[run.open] >= 0
        bins, parents = run.parents
        whole, built_totals, totals = np.empty((len(run.open), *by_bin.shape[1:])), totals, np.empty((len(run.open), 3))
        whole[chosen] = _filled(by_bin, built_totals, layout)
        whole[~chosen] = bins - whole[chosen]
        whole[whole[..., 0] <= 0] = 0.0
        totals[chosen], totals[~chosen] = built_totals, parents - built_totals
    for node, stats in zip(run.open, totals):
        tree.stats[node] = stats
    gains, slots, places, lefts, orders = _best(whole, totals, layout)
    opened, built, parents = [], [], []
    for i, node in enumerate(run.open):
        rows, total, squares = totals[i]
        spread = squares / rows - (total / rows) ** 2 if rows else 0.0
        if not gains[i] > 1e-14 * squares / max(rows, 1.0) or abs(spread) < np.finfo(float).eps:
            continue
        slot = int(slots[i])
        if layout.arity[slot]:
            chosen = orders[slot][i][: places[i] + 1]
            goes_left = np.isin(np.arange(layout.arity[slot]), chosen)
            tree.splits[node] = (slot, sorted(chosen.tolist()), int(layout.arity[slot]))
        else:
            goes_left = layout.bin_of[run.place][slot] <= places[i]
            tree.splits[node] = (slot, float(layout.own[run.place][slot][places[i]]), 0)
        left = np.zeros(3)
        left[: lefts.shape[1]] = lefts[i]
        children = tree.add(left), tree.add(np.where(np.arange(3) < lefts.shape[1], totals[i] - left, 0.0))
        tree.gains[node] = float(gains[i])
        tree.nexts[node] = np.full(tree.codes, children[1])
        tree.nexts[node][: len(goes_left)][goes_left] = children[0]
        opened += children
        built.append(children[0] if 2 * left[0] <= rows else children[1])
        parents.append(i)
    run.level += 1
    run.open, run.built, run.parents = ([], [], None) if run.level == depth else (opened, built, (whole[parents], totals[parents]))


def rescored(packed: DataFrame, layout: Layout, runs: Sequence[Run], depth: int) -> DataFrame:
    """The blocks with the scores of every run after its last tree."""
    used = sorted(set().union(*[run.trees[-1].used() for run in runs]))
    last = [(run.trees[-1].table(used), run.weight(len(run.trees) - 1) * run.trees[-1].values()) for run in runs]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, _, numbers, flags, scores, block in _unpacked(batches, layout):
            codes, rows = layout.columns(used, numbers, flags), np.arange(len(fold))
            new = np.zeros((len(last), len(fold))) if scores is None else scores.copy()
            for i, (table, values) in enumerate(last):
                new[i] += np.take(values, _reached(table, depth, codes, rows, layout.most_codes))
            yield pa.RecordBatch.from_arrays([*block.columns[:-1], pa.array([new.tobytes()], pa.binary())], _NAMES)

    return packed.mapInArrow(score, _BLOCK)


def right_shares(packed: DataFrame, layout: Layout, runs: Sequence[Run]) -> np.ndarray:
    """Per run the share of the rows of its fold that its score puts on the right side."""
    places = [layout.left_out[run.place] for run in runs]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, len(places)))
        for batch in batches:
            for i in range(batch.num_rows):
                fold, label, scores = (
                    np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in ((0, np.int32), (1, np.int8), (2, float))
                )
                right = (scores.reshape(len(places), -1) > 0) == (label > 0)
                for k in np.unique(fold):
                    own, rows = np.flatnonzero(np.equal(places, k)), fold == k
                    found[0, own] += right[own][:, rows].sum(axis=1)
                    found[1, own] += rows.sum()
        run = pa.array(range(len(places)), pa.int32())
        yield pa.RecordBatch.from_arrays([run, *[pa.array(f) for f in found]], ["run", "right", "rows"])

    kinds = "run int, right double, rows double"
    summed = packed.select("fold", "label", "scores").mapInArrow(count, kinds).groupBy("run").agg(
        (F.sum("right") / F.sum("rows")).alias("share")
    )
    found = summed.agg(F.sort_array(F.collect_list(F.struct("run", "share")))).first()[0]
    return np.array([r["share"] for r in found])


def grow(
    packed: DataFrame, layout: Layout, runs: Sequence[Run], depth: int, trees: int, shares_at: Sequence[int] = (), squares: bool = False
) -> dict[int, np.ndarray]:
    """Grows all runs' trees; gives the shares of rows left out that are right after as many trees as wanted. With ``squares``
    those are counted by bin too, so that the deepest leaves have theirs, which only a model that is kept needs."""
    # Scores are written, not cached: a cached table's plan holds those of all it was made from, twice each.
    shares, current, path, spark = {}, packed, None, packed.sparkSession
    try:
        for number in range(trees):
            # The first tree fits the labels, whatever the step size.
            firsts = {run.place: run for run in runs}
            growing = runs if number else list(firsts.values())
            for run in growing:
                run.begin(layout.most_codes)
            while any(run.open for run in growing):
                for run, found in zip(growing, counted(current, layout, growing, 3 if squares else 2)):
                    if found is not None:
                        grown(run, layout, *found, depth)
            for run in runs:
                if len(run.trees) == number:
                    run.trees.append(firsts[run.place].trees[0])
            if number + 1 == trees and not shares_at:
                break
            before, path = path, remove_at_exit(spark, f"{shared_folder(spark)}/riskbook-scores-{uuid4().hex}")
            rescored(current, layout, runs, depth).write.parquet(path)
            current = spark.read.schema(_BLOCK).parquet(path)
            if before:
                remove_now(spark, before)
            if number + 1 in shares_at:
                shares[number + 1] = right_shares(current, layout, runs)
    finally:
        if path:
            remove_now(spark, path)
    return shares


# --- the library's estimator ---------------------------------------------------------------------------


def supported(model: Estimator, rows: DataFrame) -> bool:
    """Whether the model is one of boosted trees with settings that are grown here; the library fits any others."""
    if not isinstance(model, GBTClassifier):
        return False
    plain = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "lossType": "logistic", "minInstancesPerNode": 1,
             "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0}
    if any(model.getOrDefault(name) != value for name, value in plain.items()):
        return False
    if model.isSet("weightCol") or model.isSet("validationIndicatorCol") or model.getLabelCol() != "label":
        return False
    size = len(rows.select(model.getFeaturesCol()).first()[0])
    return bool((arities(rows, model.getFeaturesCol(), size) <= model.getMaxBins()).all())


def fit_any(model: Estimator, rows: DataFrame) -> Model:
    """Fits a model of any kind: boosted trees of many rows here, all else by the library."""
    return fit(model, rows) if supported(model, rows) and rows.count() >= MANY_ROWS else model.fit(rows)


def fit(model: GBTClassifier, rows: DataFrame) -> GBTClassificationModel:
    """The library's fitted model of trees grown here."""
    features = model.getFeaturesCol()
    rows = rows.select(F.lit(0).alias("fold"), "label", features)
    layout = layout_of(model, rows, [-1])
    packed = blocks(rows, features, layout).persist(StorageLevel.DISK_ONLY)
    run = Run(0, model.getStepSize())
    try:
        grow(packed, layout, [run], model.getMaxDepth(), model.getMaxIter(), squares=True)
    finally:
        packed.unpersist()
    return _as_model(model, run, len(layout.arity), rows)


def layout_of(model: GBTClassifier, rows: DataFrame, left_out: Sequence[int]) -> Layout:
    features, bins = model.getFeaturesCol(), model.getMaxBins()
    fold, sample = sampled(rows, features, len(left_out), bins, model.getSeed())
    return Layout(arities(rows, features, sample.shape[1]), fold, sample, left_out, bins)


def searched(rows: DataFrame, model: GBTClassifier, folds: int, settings: Sequence[tuple[int, float]], steps: Sequence[int]) -> dict:
    """Per depth and step size, and per number of steps, the accuracy on each fold of the models of the other folds' rows."""
    layout = layout_of(model, rows, range(folds))
    packed = blocks(rows, model.getFeaturesCol(), layout).persist(StorageLevel.DISK_ONLY)
    found = {}
    try:
        for depth in sorted({d for d, _ in settings}):
            sizes = sorted({size for d, size in settings if d == depth})
            runs = [Run(fold, size) for size in sizes for fold in range(folds)]
            shares = grow(packed, layout, runs, depth, max(steps), sorted(set(steps)))
            for k, share in shares.items():
                found.update({(depth, size, k): share[i * folds : (i + 1) * folds] for i, size in enumerate(sizes)})
    finally:
        packed.unpersist()
    return found


def _as_model(model: GBTClassifier, run: Run, size: int, rows: DataFrame) -> GBTClassificationModel:
    context = rows.sparkSession.sparkContext
    jvm, new_array = context._jvm, context._gateway.new_array
    ml = jvm.org.apache.spark.ml

    def doubles(values):
        array = new_array(jvm.double, len(values))
        for i, v in enumerate(values):
            array[i] = float(v)
        return array

    def node_of(tree: Tree):
        built: dict[int, object] = {}
        for node in reversed(range(len(tree.splits))):
            count, total, squares = tree.stats[node]
            mean = float(total / count) if count else 0.0
            spread = float(squares / count - mean * mean) if count else 0.0
            stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles(tree.stats[node]), int(count))
            if tree.splits[node] is None:
                built[node] = ml.tree.LeafNode(mean, spread, stats)
                continue
            slot, at, arity = tree.splits[node]
            split = ml.tree.CategoricalSplit(slot, doubles(at), arity) if arity else ml.tree.ContinuousSplit(slot, at)
            right, left = sorted({int(k) for k in tree.nexts[node]}, reverse=True)
            built[node] = ml.tree.InternalNode(mean, spread, tree.gains[node], built[left], built[right], split, stats)
        return built[0]

    kind = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees = new_array(kind, len(run.trees))
    for i, tree in enumerate(run.trees):
        trees[i] = kind(node_of(tree), size)
    weights = doubles([run.weight(i) for i in range(len(run.trees))])
    fitted = ml.classification.GBTClassificationModel(model.uid, trees, weights, size, 2)
    return model._copyValues(GBTClassificationModel(fitted))
