"""Spelling variants against all pairs of words, and defined cases."""

import random
import re
import zlib
from collections import Counter

from riskbook.llm import spelling as sp

SCHEMA = "doc_id long, text string, word string, n int, prefix string"


def _edits(a, b):
    """Whether two words differ by one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(counts, ratio=10):
    near = {w: [v for v in counts if v != w and _edits(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-counts[v], v))
            if counts[best] >= ratio * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), n, len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def _found(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_variants_are_those_of_all_pairs(spark):
    chance = random.Random(7)
    counts = {}
    for _ in range(60):
        word = "".join(chance.choice("abé") for _ in range(chance.randint(1, 7)))
        counts[word] = chance.choice([1, 2, 30, 500, 6000])
        for _ in range(3):
            at = chance.randrange(len(word))
            counts[word[:at] + chance.choice(["", "a", "bb", "é"]) + word[at + chance.randint(0, 1) :] or "a"] = chance.choice([1, 3, 40])
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert _found(sp.variants(frame)) == _variants(counts)


def test_a_chain_of_forms_and_a_word_with_very_many_neighbours(spark):
    counts = {"a" * 8 + "b" * i: 10 ** (i + 1) for i in range(7)}
    counts |= {"hotword"[:i] + c + "hotword"[i + 1 :]: 2 for i in range(7) for c in "abcdefgijklmnpqsuvxyzàâäåæçè"}
    counts["hotword"] = 10**6
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = _found(sp.variants(frame))
    assert found == _variants(counts)
    assert found["aaaaaaaa"][1] == "a" * 8 + "b" * 6 and found["hotword"][3] == len(counts) - 8


def _words(docs):
    counted = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counted[run] += 1
    return {w: n for w, n in counted.items() if len(w) >= 7 and n >= 2}


def test_words_of_documents(spark):
    texts = [None, "", "short words only", "Grüße Straßen STRASSEN straßen ÄPFELCHEN äpfelchen äpfelchen", "letters7letters letters-lettera", "x" * 50_000]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, "repeated Variation variation variatiom") for i in range(200)] + [(None, texts[3])] * 2
    frame = spark.createDataFrame([(k, t, "clash", 1, "clash") for k, t in docs], SCHEMA).repartition(4)
    words = _words(docs)
    assert {r.word: r.n for r in sp.word_counts(sp.misspelt(sp.runs(frame))).collect()} == words
    assert _found(sp.document_variants(frame)) == _variants(words)


def test_empty_tables(spark):
    assert sp.document_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    assert sp.document_variants(spark.createDataFrame([(1, None, "", 1, "")], SCHEMA)).count() == 0


def test_every_pair_lies_in_one_group_only(spark):
    """Rotations of words with repeated letters: the pair counts once although several deletions give it."""
    frame = spark.createDataFrame([("aaaa", 5), ("aaa", 50), ("aaaaa", 500)], "word string, n long")
    assert _found(sp.variants(frame)) == _variants({"aaaa": 5, "aaa": 50, "aaaaa": 500})
