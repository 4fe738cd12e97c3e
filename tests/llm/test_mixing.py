"""Targets against a plain reshare, rates against the dual, totals near targets, and the edge cases."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.llm.mixing import mix_sources, mixed_documents, round_to_copies, source_targets
from viewloom.llm.shared import Staging

SCHEMA = "doc_id long, text string, source string, copies int, place int"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Reshare what is above the limits, source by source, until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, free, target = sum(sizes.values()), set(order), {}
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if unit * weight[s] >= most * sizes[s]}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        if not over:
            return target | {s: unit * weight[s] for s in free}
        free -= over
    return target


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    out = []
    for i in range(3000):
        source = rng.choice(["a"] * 30 + ["b", "B", "é", "z", None] + ["c"] * 3)
        out.append((i, " ".join(["w"] * int(rng.lognormvariate(4, 1.2))), source, 0, 0))
    return out + [(None, "one two", "a", 0, 0), out[0], out[0], (5000, None, "a", 0, 0), (5001, "", "empty", 0, 0), (5002, " \t", "b", 0, 0)]


def test_targets_copies_and_totals(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    got = mix_sources(docs).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= max(5, 0.001 * want[s])
    again = mix_sources(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_tilts_solve_the_dual(spark):
    sizes = [("a", 1_000_000), ("b", 10), ("c", 3), ("d", 77), ("e", 500_000), (None, 1)]
    df = spark.createDataFrame(sizes, "source string, size long")
    found = source_targets(df, Staging(spark, "test")).collect()
    assert sum(r.target for r in found) == pytest.approx(1_500_091)
    for r in found:
        assert r.source_size * np.exp(r.tilt) == pytest.approx(r.target, rel=1e-9)
    few = source_targets(df, Staging(spark, "test"), share=1e-9).collect()
    assert all(r.source_size * np.exp(r.tilt) == pytest.approx(r.target, rel=1e-9) for r in few)


def test_rounding_leaves_less_than_a_small_document():
    rng = np.random.default_rng(1)
    for rate in (0, 0.01, 0.4, 1, 2.9, 3):
        sizes = np.sort(rng.integers(1, 2000, 300))[::-1]
        copies = round_to_copies(sizes, rate, 3)
        assert abs((copies * sizes).sum() - rate * sizes.sum()) <= sizes[-4]


def test_a_very_long_document_does_not_cost_the_target():
    sizes = np.array([100_000] + [400] * 499)
    assert abs((round_to_copies(sizes, 2.9, 3) * sizes).sum() - 2.9 * sizes.sum()) <= 400
    sizes[0] = 1_000_000
    assert abs((round_to_copies(sizes, 0.8, 3) * sizes).sum() / (0.8 * sizes.sum()) - 1) <= 0.05


def test_parts_make_up_for_each_other(spark):
    rows = [(i, "w " * 40, "a") for i in range(1500)] + [(2000, "w " * 100_000, "a")]
    rows += [(3000 + i, "w " * 50, "b") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_sources(docs, weights=(1, 3)).collect()
    assert len(got) == len(rows) and len({r.doc_id for r in got}) == len(rows)
    for s in "ab":
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 200
        assert all(0 <= r.copies <= 3 and r.taken == r.copies * r.size for r in mine)


def test_mixed_documents_and_edge_cases(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).drop("copies")
    total = mix_sources(docs).agg(F.sum("copies")).first()[0]
    mixed = mixed_documents(docs)
    assert mixed.columns == [*docs.columns, "copies"]
    assert mixed.agg(F.sum("copies")).first()[0] == total
    assert mix_sources(docs.limit(0)).collect() == []
    nothing = mix_sources(spark.createDataFrame([(1, None, None), (None, "", "a")], "doc_id long, text string, source string"))
    assert sorted((r.size, r.target, r.taken) for r in nothing.collect()) == [(0, 0.0, 0), (0, 0.0, 0)]


def plain_tilt(sizes, priors, target, most=3):
    """The tilt at which min(most, prior x exp(tilt)) meets the target, by halving an interval."""
    low, high = -60.0, 60.0
    for _ in range(300):
        middle = (low + high) / 2
        taken = (sizes * np.minimum(most, priors * np.exp(middle))).sum()
        low, high = (middle, high) if taken < target else (low, middle)
    return high


def test_limits_that_bind_take_the_tilt_from_the_closed_form(spark):
    rng = np.random.default_rng(8)
    rows = [(s, int(n), float(q)) for s, spread in (("a", 0.1), ("b", 3.0), (None, 6.0))
            for n, q in zip(rng.integers(1, 3000, 400), np.exp(rng.normal(0, spread, 400)))]
    rows += [("a", 900, 0.0), ("z", 5, 0.0), ("b", 0, 2.0)]
    df = spark.createDataFrame(rows, "source string, size long, prior double").repartition(5)
    found = {r.source: r for r in source_targets(df, Staging(spark, "test")).collect()}
    assert found["z"].target == 0 and found["z"].tilt is None
    differ = 0
    for s in ("a", "b", None):
        sizes, priors = np.array([r[1:] for r in rows if r[0] == s and r[2] > 0]).T
        taken = (sizes * np.minimum(3, priors * np.exp(found[s].tilt))).sum()
        assert taken == pytest.approx(found[s].target, rel=1e-8)
        if found[s].target < 2.999 * sizes.sum():
            assert found[s].tilt == pytest.approx(plain_tilt(sizes, priors, found[s].target), abs=1e-6)
            differ += abs(found[s].tilt - np.log(found[s].target / (sizes * priors).sum())) > 0.1
    assert differ  # without the limit the tilt would be the logarithm of a quotient


def test_priors_shape_the_copies(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "w " * int(n), "ab"[i % 2], [0.2, 1.0, 5.0][i % 3], None) for i, n in enumerate(rng.integers(20, 90, 3000))]
    rows += [(4000, "w w", "a", None, 1), (4001, "w " * 50, "a", 0.0, 1), (4002, "w w", "b", float("nan"), 1), (4003, "w", "b", -1.0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, q double, prior int")
    got = {r.doc_id: r for r in mix_sources(docs, prior="q").collect()}
    assert len(got) == len(rows) and [got[i].copies for i in (4001, 4002, 4003)] == [0, 0, 0]
    for s in "ab":
        mine = [r for r in got.values() if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 200
        copies = [np.mean([got[i].copies for i in range(3000) if "ab"[i % 2] == s and i % 3 == k]) for k in range(3)]
        assert copies[0] < copies[1] < copies[2]
    again = mix_sources(docs.repartition(3), prior="q").collect()
    assert sorted(map(str, got.values())) == sorted(map(str, again))
    assert mixed_documents(docs, prior="q").where("doc_id > 4000").count() == 0
