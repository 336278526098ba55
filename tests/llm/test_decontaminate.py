"""Decontamination against plain window search, on both ways of joining."""

import random
import re

import pytest

from riskbook.llm import decontaminate as dc

DOCS, ITEMS = "doc_id long, text string, n_words int, row int, words string", "item_id long, text string"
PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _words(text):
    return PATTERN.findall((text or "").translate(LOWER))


def _expected(docs, items):
    windows = {}
    for item, text in items:
        w = _words(text)
        n = min(len(w), 13)
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    found = []
    for key, text in docs:
        w, hit, names = _words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(w[i : i + n])]
        ids = tuple(sorted(str(x) for x in names if x is not None))
        found.append((key, len(w), len(hit), ids, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(found, key=str)


def _found(spark, docs, items, most):
    table = spark.createDataFrame([(*d, 1, 2, "x") for d in docs], DOCS)
    found = dc.contamination(table, spark.createDataFrame(items, ITEMS), most_keys=most).collect()
    return sorted([(r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in found], key=str)


@pytest.mark.parametrize("most", [0, dc.MOST_BROADCAST_KEYS])
def test_every_shared_window_is_found(spark, most):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Éa", "éa", "ΣΣ", "I", "K"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([13, 14, 20, 60])))) for i in range(30)]
    items += [(100, "short item of five words"), (101, "Two words"), (102, "single"), (103, ""), (104, None), (None, items[0][1]), (3, items[3][1])]
    docs = []
    for i in range(120):
        parts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            w = items[rng.randrange(30)][1].split()
            a = rng.randrange(len(w))
            piece = ", ".join(w[a : a + rng.randint(10, 30)])
            parts += [rng.choice([piece, piece.upper(), piece.replace("É", "é")]), rng.choice(["x y", "."])]
        parts.append(rng.choice(["", "SHORT item, of five-words!", "two\nWORDS", "singles", "single"]))
        docs.append((i, " ".join(parts)))
    docs += [(200, None), (201, ""), (None, items[1][1]), (202, items[1][1]), (202, items[1][1])]
    assert _found(spark, docs, items, most) == _expected(docs, items)


def test_long_text_with_a_passage_at_its_end(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = [(1, "filler text " * 60_000 + item), (2, item)]
    assert _found(spark, docs, [(7, item)], 10) == _expected(docs, [(7, item)])


def test_filtering_keeps_columns_and_clean_documents(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, item, 1, 2, "x"), (2, "clean", 1, 2, "x"), (3, None, 1, 2, "x"), (None, "z", 1, 2, "x")], DOCS)
    kept = dc.keep_clean(docs, spark.createDataFrame([(1, item)], ITEMS))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None"]


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b", 1, 2, "x")], DOCS)
    assert [r.n_hit for r in dc.contamination(one, none).collect()] == [0]
    assert dc.contamination(spark.createDataFrame([], DOCS), none).collect() == []
