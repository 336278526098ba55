"""The Merkle manifest against a plain tree, positions against an appended log, and defined cases."""

import hashlib
import zlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from riskbook.llm import merkle as m

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest int, place string"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _hash("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def _levels(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([_hash(levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def _path(levels, at):
    path = []
    for nodes in levels[:-1]:
        first = at - at % 16
        run = nodes[first : first + 16]
        path.append((at - first, run[: at - first] + run[at - first + 1 :]))
        at //= 16
    return path


def _lower(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _expected(docs):
    by_source = {}
    for d in docs:
        by_source.setdefault(d[1], []).append((d[0] is not None, d[0] or 0, _leaf(d), d))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: _levels([leaf for _, _, leaf, _ in sorted(rows, key=lambda r: r[:3])]) for s, rows in by_source.items()}
    top = _levels([trees[s][-1][0] for s in names]) if names else []
    out = []
    for s, rows in by_source.items():
        for at, (_, _, leaf, d) in enumerate(sorted(rows, key=lambda r: r[:3])):
            path = _path(trees[s], at) + _path(top, names.index(s))
            tampered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            now = _leaf((*d[:4], _lower(d[4]))) if tampered else leaf
            for place, others in path:
                now = _hash(others[:place] + [now] + others[place:])
            root = top[-1][0]
            out.append((d[0], leaf, trees[s][-1][0], root, _hash(x for _, others in path for x in others), now, now == root))
    return sorted(out, key=str)


def _frame(spark, docs, parts=5):
    return spark.createDataFrame([(*d, "tree", 1, "place") for d in docs], SCHEMA).repartition(parts)


def _rows(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.fixture(scope="module")
def docs():
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(5000)]
    rows += [(10_000 + i, "sixteen", "de", None, f"A{i}") for i in range(16)] + [(10_100 + i, "seventeen", None, i, None) for i in range(17)]
    rows += [(10_200 + i, f"s{i}", "en", 1, "ÄB c") for i in range(40)] + [(10_300, None, None, None, None), (None, None, "x", 1, "N")]
    rows += [(10_400, "twins", "en", 1, "same"), (10_400, "twins", "en", 1, "same"), (10_400, "twins", "en", 1, "other")]
    return rows + [(10_500, "", "en", 0, ""), (10_501, "é", "en", 1, "Z" * 100_000)]


def test_same_tree_as_a_plain_one(spark, docs):
    """One source of more leaves than a block, others at the limits of a run, and 46 sources."""
    found, expected = _rows(m.manifest(_frame(spark, docs), COLUMNS)), _expected(docs)
    assert found == expected
    assert 0 < sum(not row[-1] for row in found) < len(found) / 4


def test_small_blocks_give_the_same_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(m, "BUILD_LEVELS", 1)
    assert _rows(m.manifest(_frame(spark, docs[:700] + docs[5000:]), COLUMNS)) == _expected(docs[:700] + docs[5000:])


def test_empty_table_and_single_row(spark):
    assert _rows(m.manifest(_frame(spark, []), COLUMNS)) == []
    one = [(7, "a", None, 3, "T")]
    assert _rows(m.manifest(_frame(spark, one), COLUMNS)) == _expected(one)


def _appended(size):
    """(level, index) in the order in which an appending writer finishes the nodes."""
    log, open_, done = [], [0] * 20, [0] * 20
    height = m.levels_of(size)

    def finish(level):
        log.append((level, done[level]))
        done[level] += 1
        open_[level + 1] += 1
        if open_[level + 1] == 16 and level < height:
            open_[level + 1] = 0
            finish(level + 1)

    for _ in range(size):
        finish(0)
    for level in range(1, height + 1):
        if open_[level]:
            open_[level] = 0
            finish(level)
    return log


@given(st.integers(1, 5000))
def test_positions_are_those_of_an_appended_log(size):
    log = _appended(size)
    assert [m.position(level, index, size) for level, index in log] == list(range(len(log)))


def test_written_log_is_in_completion_order(spark, docs, tmp_path):
    log = m.write_log(_frame(spark, docs), COLUMNS, str(tmp_path / "log"))
    rows = [r for r in log.filter("tree = 'hot'").collect()]
    assert [(r.level, r["index"]) for r in sorted(rows, key=lambda r: r.position)] == _appended(5000)
    assert sorted(r.position for r in rows) == list(range(len(rows)))
