"""Embedding near-duplicates against all pairs in double precision, recall of the bands, and the estimates."""

import math

import numpy as np
import pytest
from brute import Union

from zoneflow.llm import vectors as vx


def brute(rows, threshold):
    good = [
        (i, np.array(v, dtype=np.float64)) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    union, links = Union({i for i, _ in rows if i is not None}), dict.fromkeys(range(len(good)), 0)
    for a in range(len(good)):
        for b in range(a):
            x, y = good[a][1], good[b][1]
            if len(x) == len(y) and x @ y / math.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a] += 1
                links[b] += 1
                union.join(good[a][0], good[b][0])
    return sorted((good[k][0], n, union.find(good[k][0])) for k, n in links.items())


def material(n=400, dim=24, seed=0):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dim))
    near = base[rng.integers(0, 20, n // 2)] + rng.normal(size=(n // 2, dim)) * 0.12
    x = np.concatenate([base, near, near[: n // 4]]).astype(np.float32)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def run(spark, rows, p=vx.Params()):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, n_links int")
    return vx.near_duplicates(df, p).collect()


@pytest.mark.parametrize("chunk", [1024, 20])
def test_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(vx, "CHUNK", chunk)
    rows = material()
    found = run(spark, rows, vx.Params(miss=1e-5))
    want = brute(rows, 0.9)
    assert sum(n for _, n, _ in want) > 2000
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == want


def test_recall_is_over_nine_tenths(spark):
    rows = material(seed=3)
    got = sum(r.n_links for r in run(spark, rows))
    want = sum(n for _, n, _ in brute(rows, 0.9))
    assert 0.9 * want <= got <= want


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [1.0, 0.0]),
        (8, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [2.0, 0.01]), (11, [-1.0, 0.0]), (12, [1e-30, 0.0]),
        (13, [3e38, 0.0]),
    ]
    found = {(r.vec_id, r.n_links, r.component_id, r.kept) for r in run(spark, rows)}
    alone = {(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 11)}
    assert found == alone | {
        (7, 5, 7, True), (8, 5, 7, False), (10, 5, 7, False), (12, 5, 7, False), (13, 5, 7, False), (None, 0, None, True),
    }
    assert run(spark, []) == []


def test_bound_holds_pairs_and_estimates_are_unbiased():
    rng = np.random.default_rng(5)
    dim, n = 64, 4000
    q = rng.normal(size=dim)
    q /= np.linalg.norm(q)
    other = rng.normal(size=(n, dim))
    other -= (other @ q)[:, None] * q
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    o = 0.9 * q + math.sqrt(1 - 0.81) * other
    wide = vx.rotations(dim, 60 * dim)
    means = []
    for k in range(60):
        p = wide[:, k * dim : (k + 1) * dim]
        own, turned = o @ p, q @ p
        factor = np.abs(own).sum(axis=1) / math.sqrt(dim)
        estimate = (np.sign(own) @ turned) / math.sqrt(dim) / factor
        spread = np.sqrt(1 - factor**2) / factor / math.sqrt(dim - 1) * math.sqrt(1 - 0.81)
        assert (np.abs(estimate - 0.9) <= 5 * spread).all()
        means.append(estimate.mean())
    assert abs(np.mean(means) - 0.9) < 0.005


def test_shape_reaches_the_recall():
    for n in (10, 10_000, 10**9):
        s = vx.Shape.of(n, vx.Params())
        agree = (1 - math.acos(0.9) / math.pi) ** s.bits
        assert (1 - agree) ** s.bands <= 1e-3


def test_codes_keep_pairs_at_the_threshold_and_drop_unrelated_ones():
    rng = np.random.default_rng(8)
    for dim in (3, 16, 64, 300):
        x = rng.normal(size=(4000, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        other = rng.normal(size=x.shape)
        other -= (other * x).sum(axis=1, keepdims=True) * x
        other /= np.linalg.norm(other, axis=1, keepdims=True)
        turn = vx.rotations(dim, vx.CODE_BITS)[:, : vx.CODE_BITS]
        apart = ((x @ turn > 0) != ((0.9 * x + math.sqrt(1 - 0.81) * other) @ turn > 0)).sum(axis=1)
        assert (apart <= vx.most_apart(vx.Params())).mean() > 0.999
        if dim >= 64:
            strangers = ((x @ turn > 0) != (np.roll(x, 1, axis=0) @ turn > 0)).sum(axis=1)
            assert (strangers <= vx.most_apart(vx.Params())).mean() < 0.01


@pytest.mark.parametrize("small", [64, 3])
def test_pairs_of_dealt_buckets(monkeypatch, small):
    monkeypatch.setattr(vx, "SMALL", small)
    lengths, own = np.array([3, 1, 5, 4]), np.array([0, 0, 0, 0, 1, 1, 1, 1, 1, 0, 1, 0, 1])
    parts = vx._brought_together(lengths, own, np.array([0, 0, 1, 0]), np.array([0, 0, 1, 1]))
    got = sorted((int(a), int(b)) for x, y in parts for a, b in zip(x, y))
    inner = [(a, b) for first, n in ((0, 3), (4, 5)) for a in range(first, first + n) for b in range(a + 1, first + n)]
    assert got == sorted(inner + [(9, 10), (9, 12), (11, 10), (11, 12)])
