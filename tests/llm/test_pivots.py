"""Exact top-k by inner product: against brute force on hot, tied and odd rows."""

import math

import numpy as np
import pytest

from viewloom.llm import pivots
from viewloom.llm.pivots import choose_pivots, top_inner_products

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, queries, k=10):
    """rows, queries: (id, list of floats); plain Python whole numbers."""
    whole = lambda v: [math.floor(1024 * x) for x in v]
    out = {}
    for q, v in queries:
        best = {}
        for i, x in rows:
            if i != q:
                score = sum(a * b for a, b in zip(whole(v), whole(x)))
                best[i] = max(score, best.get(i, score))
        ranked = sorted(best.items(), key=lambda e: (-e[1], e[0]))[:k]
        held = {i: s for i, s in out.get(q, [])}
        out[q] = sorted({**held, **{i: max(s, held.get(i, s)) for i, s in ranked}}.items(), key=lambda e: (-e[1], e[0]))[:k]
    return {q: v for q, v in out.items() if v}


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.get(r.query_id, [])) + 1
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("kind", ["spread", "clustered", "copies"])
def test_equals_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(pivots, "BLOCK_ROWS", 60)
    monkeypatch.setattr(pivots, "BLOCK_QUERIES", 5)
    monkeypatch.setattr(pivots, "STRIDE", 7)
    monkeypatch.setattr(pivots, "SAMPLE_ROWS", 50)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6)) * rng.lognormal(0, 1, size=(400, 1))
    if kind == "clustered":
        x = rng.normal(size=(5, 6))[rng.integers(0, 5, 400)] * 3 + 0.01 * rng.normal(size=(400, 6))
    if kind == "copies":
        x[:300] = x[0]
    x = x.astype(np.float32)
    rows = [(int(i), [float(e) for e in v]) for i, v in zip(rng.permutation(400), x)]
    queries = [r for r in rows if r[0] % 20 == 0]
    df = frame(spark, rows)
    assert lists(top_inner_products(df, df.where("vec_id % 20 = 0"))) == brute(rows, queries)


def test_clusters_are_ruled_out_by_their_pivots():
    """Tight clusters: the bounds of rows in other clusters fall below the k-th score."""
    rng = np.random.default_rng(5)
    centres = np.linalg.qr(rng.normal(size=(8, 8)))[0] * 1000
    x = np.round(np.repeat(centres, 50, 0) + rng.normal(size=(400, 8))).astype(np.int64)
    longest = float(np.sqrt((x**2).sum(1)).max())
    table = choose_pivots(x, longest, 16)
    far, q = table.angles(x, False), x[3]
    least = np.abs(far - table.angles(q[None], True)).max(1)
    bound = np.sqrt((q**2).sum()) * longest * np.cos(least)
    scores = x @ q
    assert (bound >= scores * (1 - 1e-6) - 1).all()
    assert (bound < np.sort(scores)[-10]).mean() > 0.8


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.0, 0.0]), (100, [0.5, -1.0]), (100, [0.5, 3.0]),
        (3, [-1.0, 0.0005]), (4, None), (5, [None, 1.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 1.0]),
    ]
    good = [r for r in rows if r[0] is not None and r[0] not in (4, 5, 6, 7, 8, 9)]
    df = frame(spark, rows).withColumnRenamed("label", "score")
    got = lists(top_inner_products(df, df.where("vec_id % 100 = 0"), k=3))
    assert got == brute(good, [r for r in good if r[0] % 100 == 0], k=3)
    assert lists(top_inner_products(df, df.where("vec_id = 4"))) == {}
    assert lists(top_inner_products(df.limit(0), df)) == {}
    assert lists(top_inner_products(df, df.limit(0))) == {}
    assert lists(top_inner_products(df.where("vec_id = 0"), df.where("vec_id = 0"))) == {}


def test_zeros_and_large_components(spark):
    df = frame(spark, [(i, [0.0, 0.0]) for i in range(4)])
    assert lists(top_inner_products(df, df.where("vec_id = 0"), k=2)) == {0: [(1, 0), (2, 0)]}
    rows = [(i, [2.0**16 + i, -(2.0**16) * i]) for i in range(5)]  # products past the 53 bits of a double
    df = frame(spark, rows)
    assert lists(top_inner_products(df, df.where("vec_id = 4"))) == brute(rows, rows[4:])
    huge = frame(spark, [(0, [1e30]), (1, [1.0])])
    with pytest.raises(ValueError, match="64 bits"):
        top_inner_products(huge, huge)
