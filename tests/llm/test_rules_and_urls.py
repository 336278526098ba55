"""Quality rules and URL filters: plain recounts, verdicts, odd rows. Their SQL twins are in test_oracles."""

import random
import re
from collections import Counter

from riskbook.llm import quality_rules as q
from riskbook.llm import url_filters as u
from riskbook.llm.common import read_table

SCHEMA = "doc_id long, text string, lang string, kept int, n_words int, classes string"


def _recount(text):
    text = text or ""
    words = re.findall(r"[^ \t-\r]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    repeated = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^ \t-\r]", line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated),
    )


def test_counts():
    rng = random.Random(4)
    pieces = ["a", "b", "the", " ", "\n", "\t", "#", "é", "\x0b", "\x1c", "\xa0", "A&B ", "\n\n", "x y z ", "|"]
    for _ in range(500):
        text = "".join(rng.choices(pieces, k=rng.randint(0, 40)))
        assert q.measure(text)[:5] == _recount(text)
    assert q.measure(None)[:5] == (0, 0, 0, 0, 0)


def _prose(rng, n):
    common = "the of and to in is that".split()
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choices("aeinrst", k=6)) for _ in range(n)) + "."


def test_verdicts_and_odd_rows(spark):
    rng = random.Random(8)
    good = [(i, _prose(rng, 200), "en") for i in range(60)]
    odd = [
        (100, "&&& ".join(f"x{i}y" for i in range(300)), "en"), (101, " ".join(f"AB{i}C!!" for i in range(300)), "en"),
        (102, None, "en"), (103, "", None), (104, "short", "en"), (105, "one two three " * 100, "en"),
        (106, _prose(rng, 60_000), "en"), (None, _prose(rng, 200), "en"), (107, _prose(rng, 200), None), (107, _prose(rng, 200), "xx"),
    ]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in good + odd], SCHEMA)
    found = q.quality_verdicts(docs).collect()
    assert len(found) == len(good) + len(odd)
    kept = [r.doc_id for r in found if r.kept]
    assert sorted(str(k) for k in kept) == sorted(str(k) for k in [*range(60), 106, None, 107, 107])
    assert {r.doc_id for r in found if r.base_failed} == {102, 103, 104, 105}
    filtered = q.keep_quality(docs)
    assert filtered.columns == docs.columns and filtered.count() == len(kept)


def test_rules_on_nothing(spark):
    assert q.quality_verdicts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_most_labelled_good_documents_stay(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = q.quality_verdicts(read_table(spark, sf_dir, "documents")).join(labels, "doc_id").filter("NOT base_failed").collect()
    good, bad = ([r.kept for r in rows if r.quality == k] for k in (1, 0))
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.2 * len(bad)


PAGES, OUTCOMES = "page_id long, url string, host int, good int", "page_id long, good long"


def _judge(spark, urls, outcomes=()):
    pages = spark.createDataFrame([(i, url, 1, 2) for i, url in urls], PAGES)
    return u.judge_urls(pages, spark.createDataFrame(list(outcomes), OUTCOMES)).collect()


def test_parts_and_rules(spark):
    cases = {
        "https://EN.Example.ORG/es/1?q#f": ("en.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/1": ("notexample.org", "/es/1", "org/", "allow"),
        "x://a.com/fr/": ("a.com", "/fr/", "com/fr/", "allow"), "x://a.com/de/b://c": ("a.com", "/de/b://c", "com/de/", "block"),
        "x://a.com?/de/": ("a.com", "", None, "allow"), "http://example.org": ("example.org", "", None, "allow"),
        "no scheme.org/": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "//://É.COM/fr/x\ny": ("É.com", "/fr/x\ny", "com/fr/", "allow"),
    }
    found = _judge(spark, list(enumerate(cases)))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found} == dict(enumerate(cases.values()))


def test_bad_hosts_are_blocked_and_unknown_ones_pass(spark):
    urls = [(i, f"http://{h}.site{i % 5}.net/p{i}") for i, h in enumerate(["good", "bad"] * 200)]
    outcomes = [(i, int(h == "good")) for i, h in enumerate(["good", "bad"] * 200) if i % 3 == 0]
    urls += [(1000, "http://new.elsewhere.net/"), (1001, "http://new.other.info/"), (1000, "http://new.elsewhere.net/")]
    for row in _judge(spark, urls, [*outcomes, (None, 1), (3, None)]):
        assert row.verdict == ("block" if row.host.startswith("bad") else "allow")


def test_urls_on_nothing(spark):
    assert _judge(spark, []) == [] and _judge(spark, [(1, "http://a.net/")])[0].verdict == "allow"
