"""Quality classifier learnt from positive and unlabelled texts.

Trusted positives are the training rows labelled 1; the unlabelled texts are documents of any kind, whose
labels, if they have some, are not looked at. With a class prior pi the risk of a classifier is
pi R_p(+) + R_u(-) - pi R_p(-); the last two terms estimate the risk on negatives, which cannot be less than
zero, so where a step would make it so the step goes the other way (non-negative risk). The prior is the
smoothed share of label 1 among the labelled training rows. The classifier is logistic, over quantile bins
of text statistics, so every statistic may act in any shape.

Statistics are measured once per document, in Arrow batches. At most ``MOST_POSITIVES`` and
``MOST_UNLABELLED`` rows of statistics, chosen by hash, reach the driver to fit; scoring is distributed. Held
out are the rows whose crc32 of the id as text leaves 2 when divided by 4: their labels are never read.

Defined cases: NULL and empty texts have statistics of zero and get a score like any other; several labels of
one id count as the lowest; a NULL id is not held out and has no label; without positives every score is the
prior; repeated rows are scored each; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import in_sample, stored
from riskbook.llm.quality_rules import LISTED

MOST_POSITIVES = 10_000
MOST_UNLABELLED = 10_000
BINS = 20
STEPS = 2000
RATE = 0.05
PENALTY = 1e-4
CUT = 0.7

STATISTICS = (
    "log_words", "word_length", "upper", "digits", "marks", "symbols", "beyond_ascii", "space",
    "distinct_words", "top_word", "distinct_pairs", "distinct_lines", "line_length", "common_words",
    "capital_words", "all_capital_words", "marked_words", "bars", "shouts", "longest_word", "sentences",
)
_WORD = re.compile(r"[^ \t-\r]+")
_LISTED = frozenset(LISTED)
_SYMBOLS = b"#*$%&|<>"


def statistics(text: str | None) -> list[float]:
    text = text or ""
    words = _WORD.findall(text)
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    raw = text.encode("utf-8", "replace")
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    length = len(raw)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line]
    upper, lower = int(codes[65:91].sum()), int(codes[97:123].sum())
    symbols = int(sum(codes[c] for c in _SYMBOLS))
    marks = int(codes[0x21:0x7F].sum()) - upper - lower - int(codes[48:58].sum()) - symbols
    return [
        math.log1p(n),
        sum(map(len, words)) / n,
        upper / max(1, upper + lower),
        codes[48:58].sum() / length,
        marks / length,
        symbols / length,
        codes[0x80:].sum() / length,
        (codes[32] + codes[9:14].sum()) / length,
        len(counts) / n,
        max(counts.values()) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        len(set(lines)) / max(1, len(lines)),
        math.log1p(length / max(1, len(lines))),
        sum(c for w, c in counts.items() if w.lower() in _LISTED) / n,
        sum(c for w, c in counts.items() if w[0].isupper()) / n,
        sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n,
        sum(c for w, c in counts.items() if not w[-1].isalnum()) / n,
        codes[124] / n,
        codes[33] / n,
        math.log1p(max(map(len, counts))),
        codes[46] / n,
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(text.as_py()) for text in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["id", "statistics"]
        )


class Model:
    """Bin edges per statistic, a weight per bin, and a bias."""

    def __init__(self, edges: list[np.ndarray], weights: np.ndarray, bias: float) -> None:
        self.edges, self.weights, self.bias = edges, weights, bias

    @staticmethod
    def places(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        """For each row the number of its bin of each statistic, numbered over all statistics."""
        width = BINS + 1
        columns = [i * width + np.searchsorted(e, x[:, i], "right") for i, e in enumerate(edges)]
        return np.stack(columns, axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        logits = self.weights[self.places(x, self.edges)].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def _stack(rows: pd.Series) -> np.ndarray:
    return np.array(rows.tolist(), dtype=float).reshape(len(rows), len(STATISTICS))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk with Adam over all rows."""
    if not len(positive) or not len(unlabelled):
        bias = math.log(prior / (1 - prior))
        return Model([np.zeros(0)] * len(STATISTICS), np.zeros(len(STATISTICS) * (BINS + 1)), bias)
    cuts = np.arange(1, BINS + 1) / (BINS + 1)
    both = np.concatenate([unlabelled, positive])
    edges = [np.quantile(both[:, i], cuts) for i in range(len(STATISTICS))]
    p_at, u_at = Model.places(positive, edges), Model.places(unlabelled, edges)
    size = len(STATISTICS) * (BINS + 1)
    weights, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    weights[size] = math.log(prior / (1 - prior))

    def gradient(at: np.ndarray, by_row: np.ndarray) -> np.ndarray:
        total = np.bincount(at.ravel(), np.repeat(by_row, at.shape[1]), size + 1)
        total[size] = by_row.sum()
        return total / len(at)

    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-(weights[p_at].sum(axis=1) + weights[size])))
        u = 1 / (1 + np.exp(-(weights[u_at].sum(axis=1) + weights[size])))
        negative_risk = -np.log(1 - u + 1e-12).mean() + prior * np.log(1 - p + 1e-12).mean()
        negative = gradient(u_at, u) - prior * gradient(p_at, p)
        change = prior * gradient(p_at, p - 1) + negative if negative_risk >= 0 else -negative
        change = change + PENALTY * np.append(weights[:size], 0.0)
        first = 0.9 * first + 0.1 * change
        second = 0.999 * second + 0.001 * change**2
        rate = RATE * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        weights = weights - rate * first / (np.sqrt(second) + 1e-8)
    return Model(edges, weights[:size], float(weights[size]))


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def _sample(rows: DataFrame, most: int) -> np.ndarray:
    """About ``most`` rows chosen by a hash of id and statistics, never more than twice that many. Only a table of equal
    rows can have none in the share; any of them stand for all."""
    chosen = rows.filter(in_sample(["id", "statistics"], 7, most, rows.count())).select("statistics").limit(2 * most).toPandas()
    if chosen.empty:
        chosen = rows.select("statistics").limit(most).toPandas()
    return _stack(chosen["statistics"])


def quality_scores(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality"
) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1, higher is better), predicted."""
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    measured = stored(source.mapInArrow(_measure, f"id {kind}, statistics array<double>"), "statistics")
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("label_id"))
        .agg(F.min(label).alias("label"))
    )
    share = known.agg(F.sum(F.expr("CASE WHEN label = 1 THEN 1 ELSE 0 END")).alias("k"), F.count(F.lit(1)).alias("n")).first()
    prior = ((share.k or 0) + 1) / (share.n + 2)
    trusted = measured.join(known.filter("label = 1"), F.col("id") == F.col("label_id"), "left_semi")
    model = fit(_sample(trusted, MOST_POSITIVES), _sample(measured, MOST_UNLABELLED), prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy()
            scores = model.score(flat.reshape(batch.num_rows, len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], ["id", "score"])

    scored = measured.mapInArrow(run, f"id {kind}, score double")
    return scored.select(
        F.col("id").alias(doc_id), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )
