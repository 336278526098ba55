"""Mixing: targets by hand, exact budgets, repeatability, odd rows."""

import re

import pytest

from riskbook.llm import mixing
from riskbook.llm.common import read_table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def _targets(sizes, weights=(1, 2, 3), most=3):
    """Share, cap, and share what is left again, until nothing is above its cap."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [n for n in names if n not in capped]
        rest = total - sum(most * sizes[n] for n in capped)
        target = {n: weight[n] * rest / sum(weight[f] for f in free) for n in free}
        over = {n for n in free if target[n] > most * sizes[n]}
        if not over:
            return {n: target.get(n, most * sizes[n]) for n in names}
        capped |= over


def test_targets_and_budgets(spark):
    rows = [(i, "w " * (i % 7 + 1), "abcd"[i % 4] if i % 11 else None) for i in range(300)]
    rows += [(1000, "tiny source", "e"), (1001, None, "f"), (1002, "w " * 5000, "a")]
    found = mixing.taken_words(_docs(spark, rows)).collect()
    source = {i: s for i, _, s in rows}
    sizes, taken, target = {}, {}, {}
    for r in found:
        s = source[r.doc_id]
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        target[s] = r.target
        assert r.taken <= 3 * r["size"]
    assert len(found) == len(rows)
    expected = _targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s], rel=1e-12)
        assert taken[s] == int(target[s] + 1e-9)
    assert all(r.source_size == sizes[source[r.doc_id]] for r in found)


def test_reruns_agree_whatever_the_layout(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    one = {tuple(r) for r in mixing.taken_words(docs).collect()}
    two = {tuple(r) for r in mixing.taken_words(docs.repartition(7)).collect()}
    assert one == two


def test_mixed_rows_have_the_words_taken(spark):
    rows = [(i, f"  a{i} b\tc\n d{i} ", "xyz"[i % 3]) for i in range(50)]
    docs = _docs(spark, rows)
    taken = {r.doc_id: r.taken for r in mixing.taken_words(docs).collect()}
    words = dict.fromkeys(taken, 0)
    texts = {i: t for i, t, _ in rows}
    cuts = 0
    for r in mixing.mix(docs).collect():
        words[r.doc_id] += len(re.findall(r"[^ \t-\r]+", r.text))
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        cuts += r.text != texts[r.doc_id]
    assert words == taken and cuts <= 3


def test_odd_rows(spark):
    rows = [(None, "a b", None), (None, "a b", None), (2, "", "s"), (2, "", "s"), (3, None, "t"), (4, "x " * 50_000, "s")]
    docs = _docs(spark, rows).selectExpr("*", "1 AS row", "2 AS size", "3 AS taken", "4 AS doc", "5 AS _row")
    found = mixing.taken_words(docs).collect()
    assert sorted(r["size"] for r in found) == [0, 0, 0, 2, 2, 50_000]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in found)


def test_no_words_and_no_rows(spark):
    assert [r.taken for r in mixing.taken_words(_docs(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]
    assert mixing.taken_words(_docs(spark, [])).collect() == []
    assert mixing.mix(_docs(spark, [])).collect() == []
