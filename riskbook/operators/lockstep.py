"""Logistic models and support vectors of many settings and folds fitted side by side: one pass over the rows serves all of them.

A run is a fold left out and a setting. Every run keeps a minimiser of its own on the driver, a generator that asks for the
loss and gradient at a point; a pass answers the questions of all runs at once, by matrix products over blocks of
rows. The minimisers take the steps that the library's take (limited-memory BFGS, orthant-wise with an absolute penalty and
for support vectors) on slots that are centred and scaled as it does, so a run of 10 iterations has passed through the models of 1 and 3.

The driver holds points, gradients and at most ten steps back for each run, whatever the number of rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The functions that run inside tasks travel with the job: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 4096
MEMORY = 10  # steps back that a minimiser remembers
_BLOCK = "fold binary, label binary, weight binary, counts binary, places binary, numbers binary"


# --- minimisers --------------------------------------------------------------------------------------


class StepFailed(Exception):
    """A line search that found no step; the minimiser forgets its history and tries once more."""


def _direction(steps: list, changes: list, gradient: np.ndarray) -> np.ndarray:
    """Minus the gradient times the inverse Hessian that the last steps, newest first, and their changes of gradient tell."""
    direction, scale = gradient.copy(), 1.0
    if steps:
        along = steps[0] @ changes[0]
        if not along >= 0:
            raise StepFailed
        scale = along / (changes[0] @ changes[0])
    parts = []
    for step, change in zip(steps, changes):
        parts.append((step @ direction) / (step @ change))
        if np.isnan(parts[-1]):
            raise StepFailed
        direction -= parts[-1] * change
    direction *= scale
    for step, change, part in reversed(list(zip(steps, changes, parts))):
        direction += (part - (change @ direction) / (step @ change)) * step
    return -direction


def _between(a: tuple, b: tuple) -> float:
    """The lowest point of the cubic through two brackets (t, value, slope), away from their ends."""
    (low, f_low, d_low), (high, f_high, d_high) = sorted((a, b))
    d1 = d_low + d_high - 3 * (f_low - f_high) / (low - high)
    d2 = np.sqrt(d1 * d1 - d_low * d_high)
    t = high - (high - low) * (d_high + d2 - d1) / (d_high - d_low + 2 * d2)
    least, most = low + 0.1 * (high - low), low + 0.9 * (high - low)
    return least if t < least else most if t > most else t


def _strong_wolfe(at, first: tuple, t: float):
    """A step of sufficient decrease and small slope; ``at(t)`` asks for value and slope."""
    _, value, slope = first
    if slope > 0:
        raise StepFailed
    low = first
    for i in range(10):
        here = (t, *(yield from at(t)))
        if not np.isfinite(here[1]):
            t /= 2
            continue
        if here[1] > value + 1e-4 * t * slope or (here[1] >= low[1] and i > 0):
            high = here
        elif abs(here[2]) <= 0.9 * abs(slope):
            return t
        elif here[2] >= 0:
            low, high = here, low
        else:
            low, t = here, t * 1.5
            continue
        for _ in range(10):
            t = _between(low, high)
            here = (t, *(yield from at(t)))
            if here[1] > value + 1e-4 * t * slope or here[1] >= low[1]:
                high = here
                continue
            if abs(here[2]) <= 0.9 * abs(slope):
                return t
            if here[2] * (high[0] - low[0]) >= 0:
                high = low
            low = here
        raise StepFailed
    raise StepFailed


def _backtracking(at, first: tuple, t: float, shrink: float, loss: float):
    """The library takes the loss at the start, without penalty, for the value of its first try; so does this, and
    need not ask for a try that this alone rules out. After 20 tries it goes on with the last."""
    _, value, slope = first
    for tried in range(20):
        here, sloped = loss, 0.0
        if tried or not loss > value + 1e-4 * t * slope:
            there, sloped = yield from at(t)
            here = there if tried else loss
        if here > value + 1e-4 * t * slope:
            factor = shrink
        elif sloped < 0.9 * slope:
            factor = 2.1
        elif sloped > -0.9 * slope:
            factor = shrink
        else:
            return t
        if not 1e-10 <= t * factor <= 1e10:
            raise StepFailed
        if tried < 19:
            t *= factor
    return t  # the last one tried


def minimise(start: np.ndarray, most: int, tolerance: float, l1: np.ndarray | None = None):
    """A generator that yields points, takes (value, gradient) for each and returns the points after 0, 1, 2 ...
    iterations. With ``l1``, the absolute penalty of each coordinate (zeros too), steps keep to an orthant."""
    asked: list[tuple] = []

    def ask(x):
        for point, answer in asked:
            if np.array_equal(point, x):
                return answer
        answer = yield x
        asked[:] = [(x, answer), *asked[:1]]
        return answer

    def adjust(x, value, gradient):
        if l1 is None:
            return value, gradient
        above, below = gradient + l1, gradient - l1
        at_zero = np.where(below > 0, below, np.where(above < 0, above, 0.0))
        return value + float(np.abs(l1 * x).sum()), np.where(x == 0, np.where(l1 == 0, gradient, at_zero), gradient + np.sign(x) * l1)

    x = start
    value, gradient = yield from ask(x)
    full, slopes = adjust(x, value, gradient)
    first, points, steps, changes = full, [x], [], []
    values: list[float] = []
    failed = False

    def converged() -> bool:
        if len(points) > most:
            return True
        if len(values) >= 2 and abs(full - max(values)) <= tolerance * abs(first):
            return True
        return bool(np.linalg.norm(slopes) <= max(tolerance * full, 1e-8))

    def stepped(t):
        there = x + direction * t
        if l1 is None:
            return there
        orthant = np.where(x != 0, np.sign(x), np.sign(-slopes))
        return there * (np.sign(there) == orthant)

    def at(t):
        there = stepped(t)
        f, g = adjust(there, *(yield from ask(there)))
        return f, float(g @ direction)

    while not converged():
        try:
            direction = _direction(steps, changes, slopes)
            if l1 is not None:
                direction = np.where(direction * slopes < 0, direction, 0.0)
            begin = (0.0, full, float(slopes @ direction))
            fresh = len(points) == 1
            if l1 is None:
                t = yield from _strong_wolfe(at, begin, 1 / np.linalg.norm(direction) if fresh else 1.0)
                if t * np.linalg.norm(gradient) < 1e-10:
                    raise StepFailed
            else:
                t = yield from _backtracking(at, begin, 0.5 / np.linalg.norm(gradient) if fresh else 1.0, 0.1 if fresh else 0.5, value)
        except StepFailed:
            if failed:
                break
            failed, steps, changes = True, [], []
            continue
        failed = False
        new = stepped(t)
        new_value, new_gradient = yield from ask(new)
        steps, changes = [new - x, *steps][:MEMORY], [new_gradient - gradient, *changes][:MEMORY]
        x, value, gradient = new, new_value, new_gradient
        full, slopes = adjust(x, value, gradient)
        values = [*values, value][-MEMORY:]
        points.append(x)
    return points


# --- blocks of rows and passes over them ---------------------------------------------------------------


def blocks(rows: DataFrame, weight: Column) -> DataFrame:
    """The rows' filled slots in blocks of at most ``BLOCK_ROWS``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                fold, label, heavy, vectors = batch.slice(at, BLOCK_ROWS).columns
                dense = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(fold), -1)
                filled = dense != 0
                packed = [
                    fold.to_numpy().astype(np.int32), label.to_numpy().astype(np.float64), heavy.to_numpy().astype(np.float64),
                    filled.sum(axis=1).astype(np.int32), np.nonzero(filled)[1].astype(np.int32), dense[filled],
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p.tobytes()], pa.binary()) for p in packed], [c.split()[0] for c in _BLOCK.split(", ")]
                )

    columns = (F.col("fold").cast("int"), F.col("label").cast("double"), weight.cast("double"), vector_to_array("features"))
    named = [c.alias(name) for c, name in zip(columns, ("fold", "label", "weight", "slots"))]
    return rows.select(*named).mapInArrow(pack, _BLOCK)


def _unpacked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple]:
    """Fold, label, weight and the dense matrix of each block."""
    kinds = (np.int32, np.float64, np.float64, np.int32, np.int32, np.float64)
    for batch in batches:
        for i in range(batch.num_rows):
            fold, label, weight, counts, places, numbers = (
                np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(batch.columns, kinds)
            )
            dense = np.zeros((len(fold), size))
            dense[np.repeat(np.arange(len(fold)), counts), places] = numbers
            yield fold, label, weight, dense


def _summed(parts: DataFrame) -> np.ndarray:
    """The sum of the tasks' arrays: one row of fixed length."""
    return parts.agg(Summarizer.sum(array_to_vector("sums"))).first()[0].toArray()


@dataclass
class Moments:
    """Per fold: rows' weights (their sum, sum of squares, sum by label 1) and, per slot, weighted sums and squares."""

    weights: np.ndarray
    sums: np.ndarray
    squares: np.ndarray

    def two_labels(self) -> bool:
        """Whether the training rows of every fold have both labels."""
        return all(0 < ones < total for total, ones, *_ in map(self.training, range(len(self.weights))))

    def training(self, fold: int) -> tuple[float, float, np.ndarray, np.ndarray]:
        """Weight, its part with label 1, means and standard deviations of the other folds' rows."""
        rest = np.arange(len(self.weights)) != fold
        total, squared, ones = self.weights[rest].sum(axis=0)
        mean = self.sums[rest].sum(axis=0) / total
        spread = np.maximum(self.squares[rest].sum(axis=0) - total * mean**2, 0.0)
        spread[spread <= 1e-12 * np.maximum(total * mean**2, 1e-300)] = 0.0
        return total, ones, mean, np.sqrt(spread / (total - squared / total))


def moments(packed: DataFrame, folds: int, size: int) -> Moments:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((folds, 3 + 2 * size))
        for fold, label, weight, dense in _unpacked(batches, size):
            rows = np.column_stack([weight, weight**2, weight * label, weight[:, None] * dense, weight[:, None] * dense**2])
            for k in range(folds):
                found[k] += rows[fold == k].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([found.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = _summed(packed.mapInArrow(count, "sums array<double>")).reshape(folds, -1)
    return Moments(found[:, :3], found[:, 3 : 3 + size], found[:, 3 + size :])


@dataclass
class Run:
    """A setting in a fold: its minimiser, the scale of the fold's training rows and the points it has passed."""

    fold: int
    l2: float
    total: float
    mean: np.ndarray
    scale: np.ndarray
    steps: object = field(repr=False, default=None)
    asks: np.ndarray | None = None
    points: list = field(default_factory=list)

    def plain(self, point: np.ndarray) -> np.ndarray:
        """Coefficients of the unscaled slots, and the intercept last, of a point in scaled and centred ones."""
        slots = point[:-1] * self.scale
        return np.append(slots, point[-1] - slots @ self.mean)

    def answer(self, loss: float, slots: np.ndarray, rows: float) -> None:
        point = self.asks
        gradient = np.append((slots - self.mean * rows) * self.scale, rows) / self.total
        gradient[:-1] += self.l2 * point[:-1]
        self.proceed((loss / self.total + 0.5 * self.l2 * float(point[:-1] @ point[:-1]), gradient))

    def proceed(self, answer) -> None:
        try:
            self.asks = self.steps.send(answer)
        except StopIteration as end:
            self.asks, self.points = None, end.value


def losses(packed: DataFrame, size: int, runs: Sequence[Run], hinge: bool = False) -> list[tuple[float, np.ndarray, float]]:
    """Loss, and gradient by slot and by intercept, of every run's point over the rows of the other folds: one pass."""
    points = np.column_stack([run.plain(run.asks) for run in runs])
    left_out = np.array([run.fold for run in runs], np.int32)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((size + 2, len(left_out)))
        for fold, label, weight, dense in _unpacked(batches, size):
            margin = dense @ points[:-1] + points[-1]
            heavy = weight[:, None] * (fold[:, None] != left_out)
            if hinge:
                sign = (2 * label - 1)[:, None]
                short = 1 - sign * margin
                heavy *= short > 0
                loss, pull = heavy * short, -sign * heavy
            else:
                small = np.exp(-np.abs(margin))
                loss = heavy * (np.maximum(margin, 0) - label[:, None] * margin + np.log1p(small))
                pull = heavy * (np.where(margin >= 0, 1.0, small) / (1 + small) - label[:, None])
            found[0] += loss.sum(axis=0)
            found[1] += pull.sum(axis=0)
            found[2:] += dense.T @ pull
        yield pa.RecordBatch.from_arrays([pa.array([found.ravel()], pa.list_(pa.float64()))], ["sums"])

    found = _summed(packed.mapInArrow(add, "sums array<double>")).reshape(size + 2, -1)
    return [(float(found[0, i]), found[2:, i], float(found[1, i])) for i in range(len(runs))]


def scores(packed: DataFrame, size: int, models: Sequence[np.ndarray]) -> DataFrame:
    """Every row's fold, label and margins by the models (columns of coefficients, intercept last) of its own fold."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fold, label, _, dense in _unpacked(batches, size):
            for k in np.unique(fold):
                own = fold == k
                # Slot by slot, since a matrix product may round equal rows apart, and ties count in a ranking.
                margin = np.zeros((own.sum(), models[k].shape[1]))
                for slot, part in zip(dense[own].T, models[k]):
                    margin += slot[:, None] * part
                margin += models[k][-1]
                lengths = np.arange(len(margin) + 1, dtype=np.int32) * margin.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(fold[own], pa.int32()), pa.array(label[own], pa.float64()),
                        pa.ListArray.from_arrays(lengths, pa.array(margin.ravel(), pa.float64())),
                    ],
                    ["fold", "label", "margins"],
                )

    return packed.mapInArrow(score, "fold int, label double, margins array<double>")


def fit_side_by_side(
    packed: DataFrame, known: Moments, settings: Sequence[dict], most: int, tolerance: float, hinge: bool = False
) -> list[list[Run]]:
    """Per fold and setting (``regParam``, ``elasticNetParam``) the finished run; ``hinge`` is for support vectors."""
    folds, size = known.sums.shape
    runs = []
    for fold in range(folds):
        total, ones, mean, deviation = known.training(fold)
        scale = np.divide(1.0, deviation, out=np.zeros(size), where=deviation > 0)
        for setting in settings:
            l1 = setting.get("elasticNetParam", 0.0) * setting["regParam"]
            start = np.append(np.zeros(size), 0.0 if hinge else np.log(ones / (total - ones)))
            run = Run(fold, setting["regParam"] - l1, total, mean, scale)
            run.steps = minimise(start, most, tolerance, np.append(np.full(size, l1), 0.0) if l1 or hinge else None)
            run.proceed(None)
            runs.append(run)
    while active := [run for run in runs if run.asks is not None]:
        for run, found in zip(active, losses(packed, size, active, hinge)):
            run.answer(*found)
    return [runs[k * len(settings) : (k + 1) * len(settings)] for k in range(folds)]
