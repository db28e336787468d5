"""MinHash near-dedup and components against brute force."""

import random

import pytest
from brute import Union, shingles, spaced
from pyspark.sql import functions as F

from zoneflow.llm import minhash
from zoneflow.llm.components import connected_components
from zoneflow.llm.scratch import Scratch

PARAMS = minhash.Params(shingle=3, percent=85, rows=4, bands=20)


def copies(n, edits, seed=3, length=150):
    """Texts that differ from one base, which is not among them, by a few words."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(rng.choice(edits)):
            words[rng.randrange(length)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def expected(rows, k=3, percent=85):
    sets = [(i, shingles(spaced(t), k)) for i, t in rows if i is not None]
    union = Union({i for i, _ in sets})
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                union.join(sets[a][0], sets[b][0])
    return {i: union.find(i) for i, _ in sets}


def test_group_without_its_centre(spark):
    """Members of one group that are mostly not similar to each other's pivot keep every link."""
    rows = [(7 * i % 301 + 100, t) for i, t in enumerate(copies(300, [0, 1, 2, 3, 4, 5]))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), PARAMS).collect()
    want = expected(rows)
    assert len(found) == len(rows) and len(set(want.values())) < 200
    assert {r.doc_id: r.component_id for r in found} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_bucket_in_several_chunks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 16)
    rows = [(i, t) for i, t in enumerate(copies(120, [2, 3, 4, 5], seed=5))]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), PARAMS).collect()
    assert {r.doc_id: r.component_id for r in found} == expected(rows)


def test_defined_cases(spark):
    long = "word " * 30_000 + "end"
    rows = [
        (1, None, "x"), (2, "", "x"), (3, " \n\t", None), (4, "a", "x"), (5, "A", "x"), (6, "a b", "x"), (6, "a b", "x"),
        (None, "a b", "x"), (None, None, None), (9, long, "x"), (8, long, "x"), (10, "Ä b c d", "x"), (11, "ä b c d", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    found = minhash.near_duplicates(df, PARAMS).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found), key=str)
    assert got == sorted(
        [
            (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True),
            (6, 1, 6, True), (None, 1, None, True), (None, 0, None, True), (9, 2, 8, False), (8, 2, 8, True),
            (10, 2, 10, True), (11, 2, 11, True),
        ],
        key=str,
    )
    kept = minhash.keep_one(df, PARAMS)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, None, None, 8, 10, 11]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(df, PARAMS).count() == 0
    assert minhash.keep_one(df, PARAMS).count() == 0


def test_ids_that_are_narrow(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "doc_id int, text string")
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(df, PARAMS).collect()} == {1: 1, 2: 1}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(i, i + 1) for i in range(300, 360)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), edges[0]]
    union = Union({n for e in edges for n in e})
    for a, b in edges:
        union.join(a, b)
    df = spark.createDataFrame(edges, "a long, b long").union(spark.createDataFrame([(None, 7)], "a long, b long"))
    found = connected_components(df, Scratch(spark))
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {r.node: r.component for r in found.collect()} == {n: union.find(n) for n in linked}
    assert found.count() == len(linked)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_signatures_estimate_similarity():
    import numpy as np

    from zoneflow.llm import words as wd

    p = minhash.Params(rows=4, bands=200)
    a, b = np.arange(0, 1000), np.arange(200, 1200)
    values = np.concatenate([wd.mix(a.astype(np.uint64)), wd.mix(b.astype(np.uint64))])
    s = minhash.signatures(values, np.array([0, 1000]), p)
    assert abs((s[0] == s[1]).mean() - 800 / 1200) < 0.06


def test_no_python_pairs_blow_up(spark):
    """A bucket of n members gives no more than n pairs to the pivot."""
    rows = [(i, t) for i, t in enumerate(copies(80, [1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = minhash.sketch(docs, PARAMS)
    band_rows, full = minhash.buckets(classes)
    stars = band_rows.join(full, "key").where("id <> pivot")
    assert stars.groupBy("key").count().join(full, "key").where(F.col("count") >= F.col("members")).count() == 0


def test_keep_one_with_repeated_ids(spark):
    rng = random.Random(21)
    a, b, c, d = (" ".join(f"v{rng.randrange(9000)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a, "x"), (1, b, "y"), (2, c, "z"), (2, c, "z"), (3, c + " more", "w"), (None, d, "q"), (None, d, "q"), (4, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = minhash.keep_one(df, minhash.Params())
    assert kept.columns == df.columns
    got = sorted((tuple(r) for r in kept.collect()), key=str)
    assert got == sorted([rows[i] for i in (0, 1, 2, 5, 6, 7)], key=str)
