"""Nearest neighbours: recall and scores against brute force, hot groups, and the defined edge cases."""

from pathlib import Path

import numpy as np
import pytest

from viewloom.llm import ann
from viewloom.llm.ann import nearest, perturbations
from viewloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(ids, x, queries, k=10):
    out = {}
    for q in queries:
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, far)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), far[i]) for i in order]
    return out


def lists(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables here")
def test_recall_on_the_whole_table(spark):
    sf_dir = SF_DIR
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    want = brute(ids, x, np.flatnonzero(ids % 100 == 0))
    got = lists(QUERIES["op1_ann"](spark, sf_dir))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want]
    assert np.mean(hits) >= 0.9
    for q, found in got.items():
        for i, score in found:
            assert score == pytest.approx(np.sqrt(((x[ids == i][0] - x[ids == q][0]) ** 2).sum()), abs=1e-12)
        assert found == sorted(found, key=lambda f: (f[1], f[0]))


def test_copies_and_near_copies_are_exact(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 50)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 7)
    rng = np.random.default_rng(2)
    base = rng.normal(size=8)
    x = np.concatenate([np.tile(base, (300, 1)), base + 0.001 * rng.normal(size=(300, 8)), 4 * rng.normal(size=(300, 8))])
    x = x.astype(np.float32).astype(np.float64)
    ids = rng.permutation(len(x))
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], SCHEMA).repartition(5)
    queries = np.flatnonzero((ids % 10 == 0) & (np.arange(len(x)) < 600))
    got = lists(nearest(df, df.where("vec_id % 10 = 0"), 10))
    want = brute(ids, x, queries)
    same = [q for q in want if [i for i, _ in got[q]] == [i for i, _ in want[q]]]
    assert len(same) / len(want) >= 0.95


def test_recall_holds_in_dense_and_in_spread_places(spark):
    rng = np.random.default_rng(5)
    centers = 4 * rng.normal(size=(3, 32))
    x = np.concatenate([np.repeat(centers, 1500, axis=0) + 0.2 * rng.normal(size=(4500, 32)), rng.normal(size=(1500, 32))])
    ids = np.arange(len(x))
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, x)], "vec_id long, embedding array<double>, label int")
    got = lists(nearest(df, df.where("vec_id % 50 = 0"), 10))
    want = brute(ids, x, ids[::50])
    hits = {q: len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 10 for q in want}
    assert np.mean([h for q, h in hits.items() if q < 4500]) >= 0.9
    assert np.mean([h for q, h in hits.items() if q >= 4500]) >= 0.9


def test_repeated_ids_leave_room_for_others(spark):
    rows = [(1, [1.0, 0.0], 0)] + [(2, [1.0, 0.01], 0)] * 12 + [(3, [1.0, 0.02 + 0.001 * i], 0) for i in range(12)]
    rows += [(i, [1.0, 0.1 * i], 0) for i in range(4, 20)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [i for i, _ in lists(nearest(df, df.where("vec_id = 1")))[1]] == list(range(2, 12))


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (100, [2.0, 0.0], 1), (5, [1.0, 1.0], None), (5, [9.0, 9.0], 1), (None, [1.0, 0.0], 1)]
    rows += [(6, None, 1), (7, [], 1), (8, [0.0, 0.0], 1), (9, [None, 1.0], 1), (10, [nan, 1.0], 1), (200, [inf, 1.0], 1), (300, [1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.selectExpr("*", "1 AS score", "2 AS v", "3 AS bucket")
    got = lists(nearest(df, df.where("vec_id % 100 = 0")))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {0: [5, 100], 100: [0, 5]}
    assert nearest(df.limit(0), df).collect() == []
    assert nearest(df, df.limit(0)).collect() == []


def test_perturbations_come_by_cost_without_repeats():
    order = perturbations(np.array([0.1, 0.5, 0.9]), 200)
    assert [c for c, _ in order] == sorted(c for c, _ in order)
    assert len({tuple(s) for _, s in order}) == len(order) == 200
