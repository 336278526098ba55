"""Near duplicates against all pairs, components against union-find, the estimator against known sets."""

import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskbook.llm import near_dedup as nd
from riskbook.llm.common import read_table
from riskbook.llm.components import components
from riskbook.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, row int, id int, bands string"


def _roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _expected(docs, size, percent=80):
    sets = {key: nd.shingle_set(text, size) for key, text in docs}
    where = {}
    for key, one in sets.items():
        for shingle in one:
            where.setdefault(shingle, []).append(key)
    common = {}
    for keys in where.values():
        for i, a in enumerate(keys):
            for b in keys[:i]:
                common[(a, b)] = common.get((a, b), 0) + 1
    edges = [(a, b) for (a, b), n in common.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    roots = _roots(sets, edges)
    return {key: (len(sets[key]), roots[key], roots[key] == key) for key in sets}


def _found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_query_on_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert _found(QUERIES["op8_near_dedup"](spark, sf_dir)) == _expected(docs, 2)


def test_families_chains_and_odd_texts(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    base = rng.choices(words, k=120)
    docs = []
    for _ in range(60):  # a large group, each a few words from the original
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        docs.append(" ".join(copy))
    chain = rng.choices(words, k=100)
    for i in range(12):  # each near the next, the ends far apart
        docs.append(" ".join(chain))
        chain = [*chain[4:], *rng.choices(words, k=4)]
    docs += [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    docs += ["", None, " \t\n", "One", "one", "ONE  two", "one two", "É a b", "é a b", docs[0].upper(), docs[0]]
    rng.shuffle(docs)
    rows = [(i * 3 + 5, text) for i, text in enumerate(docs)]
    table = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    assert _found(nd.duplicate_groups(table, size=2)) == _expected(rows, 2)


def test_filter_keeps_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(5, text), (3, text), (3, text), (None, text), (7, "other words here"), (8, None), (9, ""), (None, "null id text")]
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "7", "8", "9", "None"]


def test_empty_table(spark):
    assert nd.duplicate_groups(spark.createDataFrame([], SCHEMA)).collect() == []
    assert nd.keep_one(spark.createDataFrame([], SCHEMA)).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, i) for i in range(6, 60)] + [(200, 201), (201, 201)]
    edges += [tuple(rng.sample(range(300, 380), 2)) for _ in range(60)]
    table = spark.createDataFrame(edges + [(None, 5), edges[0]], "u long, v long")
    nodes = {n for e in edges for n in e}
    expected = {n: r for n, r in _roots(nodes, edges).items() if n != r}
    assert {r.node: r.root for r in components(table).collect()} == expected


@given(st.integers(10, 400), st.floats(0.2, 0.98))
def test_estimate_is_near_the_similarity(n, share):
    rng = np.random.default_rng(n)
    hashes = rng.integers(0, 2**63, 2 * n, dtype=np.uint64)
    common = int(n * share)
    left, right = hashes[:n], np.concatenate([hashes[:common], hashes[n : 2 * n - common]])
    sketches = [nd.registers(x)[None, :] for x in (left, right)]
    sizes = [np.array([float(len(x))]) for x in (left, right)]
    estimate = nd.estimated_similarity(*sketches, *sizes)[0]
    assert abs(estimate - common / (2 * n - common)) < nd.SKETCH_MARGIN


def test_bands_give_back_the_registers():
    values = nd.registers(np.random.default_rng(9).integers(0, 2**63, 50, dtype=np.uint64))
    assert np.array_equal(nd.unpacked(nd.packed(values))[0], values)
    one = nd.registers(np.array([0, 2**63], np.uint64))
    assert 0 <= one.min() and one.max() < 1 << nd.REGISTER_BITS


def test_sketches_merge():
    hashes = np.random.default_rng(2).integers(0, 2**63, 300, dtype=np.uint64)
    whole = nd.registers(hashes)
    assert np.array_equal(whole, np.maximum(nd.registers(hashes[:100]), nd.registers(hashes[100:])))


def test_recall_at_the_limit(spark):
    """Of 1500 pairs of similarity 0.8, no more than one in a hundred shares no band or agrees in too few registers."""
    rng = np.random.default_rng(17)
    rows = []
    for i in range(1500):
        hashes = rng.integers(0, 2**63, 1000, dtype=np.uint64)  # 800 in common, 100 each of their own
        for side, part in enumerate((hashes[:900], np.concatenate([hashes[:800], hashes[900:]]))):
            rows.append((i, side, nd.packed(nd.registers(part)).tolist()))
    sketches = spark.createDataFrame(rows, "pair int, side int, bands array<bigint>").repartition(8)
    keyed = sketches.select("pair", "side", "bands", nd.band_keys(F.col("bands")).alias("keys"))
    left, right = (
        keyed.filter(f"side = {s}").select("pair", F.col("bands").alias(f"bands{s}"), F.col("keys").alias(f"keys{s}"))
        for s in (0, 1)
    )
    differences = nd._differences(F.col("bands0"), F.col("bands1"))
    equal = nd._equal_registers(differences)
    enough = equal >= int((0.8 - nd.EQUAL_MARGIN) * nd.REGISTERS)
    missed = left.join(right, "pair").filter(~F.arrays_overlap("keys0", "keys1") | ~enough).count()
    assert missed <= 15
    first = F.expr("get(filter(sequence(0, 47), i -> keys0[i] = keys1[i]), 0)")
    assert left.join(right, "pair").filter(~nd._first_band(differences).eqNullSafe(first)).count() == 0
    packs = {(i, side): np.array(bands) for i, side, bands in rows[:40]}
    found = {r.pair: r.n for r in left.join(right, "pair").select("pair", equal.alias("n")).filter("pair < 20").collect()}
    assert found == {i: int((nd.unpacked(packs[i, 0]) == nd.unpacked(packs[i, 1])).sum()) for i in range(20)}


def test_unlinked_families_leave_few_pairs(spark):
    """Texts that share two thirds of their words with each other, unlinked: the pairs that leave the buckets are few."""
    rng = random.Random(8)
    words = [f"w{i}" for i in range(20_000)]
    base = rng.choices(words, k=150)
    left = {}
    for size in (150, 600):
        docs = []
        for _ in range(size):
            copy = list(base)
            for at in rng.sample(range(len(copy)), 18):
                copy[at] = rng.choice(words)
            docs.append((len(docs), " ".join(copy)))
        rows = spark.createDataFrame(docs, "row long, text string").select("row", F.col("row").alias("id"), "text")
        classes = nd._sketches(rows, 2).select(F.col("row").alias("node"), "n_shingles", "bands").cache()
        keys = F.posexplode(nd.band_keys(F.col("bands"))).alias("band", "bucket")
        members = classes.select("node", F.col("node").alias("root"), keys)
        pairs = [tuple(r) for r in nd._all_pairs(members, classes, 80).collect()]
        assert len(pairs) == len(set(pairs))
        left[size] = len(pairs)
        classes.unpersist()
    assert left[600] < 0.05 * 600 * 599 / 2 and left[150] < 0.05 * 150 * 149 / 2


@given(st.integers(1, 3000), st.integers(0, 400), st.integers(0, 400))
def test_parities_never_say_more_than_what_differs(common, left, right):
    hashes = np.random.default_rng(common).integers(0, 2**63, common + left + right, dtype=np.uint64)
    one, two = (nd.parities(h) for h in (hashes[: common + left], np.concatenate([hashes[:common], hashes[common + left :]])))
    differing = int(np.bitwise_count((one ^ two).view(np.uint64)).sum())
    assert differing <= left + right and (left + right - differing) % 2 == 0
    assert left + right > 200 or differing >= 0.75 * (left + right)


def test_families_below_the_limit_leave_only_pairs_near_it(spark):
    """Texts of similarity 0.74 to 0.82 with each other: hardly any unlinked pair goes on to its full sets, and none that is linked is lost."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]
    base = rng.choices(words, k=200)
    docs = []
    for i in range(90):
        copy = list(base)
        for at in rng.sample(range(len(copy)), 5 if i < 20 else 7):
            copy[at] = rng.choice(words)
        docs.append((i, " ".join(copy)))
    sets = [nd.shingle_set(text, 2) for _, text in docs]
    similar = {
        (i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in range(len(docs)) for j in range(i + 1, len(docs))
    }
    rows = spark.createDataFrame(docs, "row long, text string").select("row", F.col("row").alias("id"), "text")
    classes = nd._sketches(rows, 2).withColumn("node", F.col("row")).cache()
    keys = F.posexplode(nd.band_keys(F.col("bands"))).alias("band", "bucket")
    members = classes.select("node", F.col("node").alias("root"), keys)
    sketched = {tuple(r) for r in nd._all_pairs(members, classes.drop("bits"), 80).collect()}
    found = {tuple(r) for r in nd._all_pairs(members, classes, 80).collect()}
    every = spark.createDataFrame(list(similar), "u long, v long")
    likely = {tuple(r) for r in nd._likely(every, classes, 80).collect()}
    classes.unpersist()
    assert found <= sketched and found <= likely
    assert all(pair in found for pair in sketched if similar[pair] >= 0.8)
    unlinked = [sum(similar[pair] < 0.8 for pair in some) for some in (found, likely, sketched)]
    assert unlinked[0] < unlinked[2] / 4 and unlinked[1] < unlinked[2] / 4
