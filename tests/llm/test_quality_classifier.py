"""The classifier: held-out accuracy, labels that must not be read, odd rows."""

import zlib

import numpy as np

from riskbook.llm import quality_classifier as qc
from riskbook.llm.common import read_table
from riskbook.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id int, score double, quality string"


def _held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def test_held_out_accuracy(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in read_table(spark, sf_dir, "labels").collect()}
    rows = QUERIES["op6_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == read_table(spark, sf_dir, "documents").count()
    assert all(r.held_out == _held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    checked = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([p == q for p, q in checked]) >= 0.93


def test_held_out_labels_are_never_read(spark, sf_dir):
    docs, labels = (read_table(spark, sf_dir, name) for name in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 1 - quality, quality) AS quality")
    one, two = ({r.doc_id: r.score for r in qc.quality_scores(docs, other).collect()} for other in (labels, flipped))
    assert one == two


def test_non_negative_risk_separates():
    rng = np.random.default_rng(0)
    shape = (len(qc.STATISTICS),)
    positive = rng.normal(1, 0.4, (300, *shape))
    unlabelled = np.concatenate([rng.normal(1, 0.4, (400, *shape)), rng.normal(-1, 0.4, (400, *shape))])
    model = qc.fit(positive, unlabelled, 0.5)
    scores = model.score(unlabelled)
    assert np.mean(scores[:400] > 0.5) > 0.95 and np.mean(scores[400:] < 0.5) > 0.95


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "a b"), (2, "word " * 80_000), (3, "\n \t"), (4, "é " * 20)]
    docs = spark.createDataFrame([(*r, 7, 0.5, "x") for r in rows], SCHEMA)
    labels = spark.createDataFrame([(2, 1), (2, 1), (4, 0), (None, 1), (3, None)], "doc_id long, quality int")
    found = qc.quality_scores(docs, labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    nothing = labels.filter("false")
    assert {r.score for r in qc.quality_scores(docs, nothing).collect()} == {0.5}
    assert qc.quality_scores(spark.createDataFrame([], SCHEMA), labels).collect() == []
