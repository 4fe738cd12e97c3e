"""Random studies against brute force, on every join path."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import viewloom.plans.view as plan
from studies.naive import naive_view
from tests.brute import brute_view
from viewloom import Limits, Study, build_view
from viewloom import schemas as S

SPLIT = Limits(broadcast_bytes=0)
TERMS = {
    ("a", "SUM"): ("sum", [("gen", "p", ["home"]), ("load", "q", ["home"])]),
    ("a", "TWICE"): ("sum", [("gen", "p", ["hub"]), ("gen", "p", ["hub"])]),
    ("a", "MEAN"): ("avg", [("gen", "p", ["home", "hub"]), ("gen", "q", ["home", "hub"])]),
    ("a", "SELF"): ("sum", [("gen", "const", None)]),
    ("b", "SUM"): ("avg", [("load", "p", ["hub"]), ("load", "nothing", ["hub"])]),
    ("b", "NONE"): ("avg", [("gen", "nothing", ["home"])]),
}
MODELS = [("g1", "gen"), ("g2", "gen"), ("g2", "gen"), ("l1", "load"), ("x", None), ("y", "")]
REFERENCES = [("a", "SUM"), ("b", "SUM"), ("a", "SUM"), ("a", "TWICE"), ("a", "MEAN"), ("a", "SELF"), ("b", "NONE"), ("b", "MISSING")]


def make(seed, step_hours, split_block=5):
    rng = random.Random(seed)
    names = [f"c{i}" for i in range(8)]
    components = [(n, rng.choice(["lib.g1", "lib.g2", "lib.l1", "g1", "other.g1", None])) for n in names]
    components += components[:2]  # listed twice
    connections = [(f"n{rng.randrange(3)}", "home", n, None) for n in names]
    connections += [(n, "hub", f"r{rng.randrange(2)}", "hub") for n in names]
    connections += connections[:3] + [("c1", "home", "c1", "home"), ("c1", None, "n0", "home")]
    simulation = []
    for _ in range(300):
        hot = rng.random() < 0.35  # a third of the rows in one series
        t = rng.choice([None, *range(12)])
        simulation.append(
            {
                "block": rng.choice("12") if rng.random() < 0.2 else ("1" if (t or 0) < 5 else "2"),
                "component": "c0" if hot else rng.choice([*names, "unknown"]),
                "output": "p" if hot else rng.choice(["p", "q", "const"]),
                "absolute_time_index": t,
                "block_time_index": t,
                "scenario_index": rng.choice([None, 0, 1]),
                "value": None if rng.random() < 0.2 else float(rng.randrange(-50, 50)),
                "basis_status": "BASIC",
            }
        )
    simulation += simulation[:20]
    start = datetime(2024, 3, 1)
    calendar = [(i, "1" if i < split_block else "2", start + timedelta(hours=step_hours * i)) for i in range(10)]
    return simulation, calendar, components, connections


def as_study(spark, simulation, calendar, components, connections):
    metrics = [(c, m, op, "sum") for (c, m), (op, _) in TERMS.items()]
    terms = [(c, m, i, *t) for (c, m), (_, ts) in TERMS.items() for i, t in enumerate(ts)]
    frame = spark.createDataFrame
    return Study(
        simulation=frame(simulation, S.SIMULATION_SCHEMA),
        calendar=frame(calendar, S.CALENDAR_SCHEMA),
        taxonomy=frame([("t", c, None) for c in ("gen", "load")], S.TAXONOMY_SCHEMA),
        taxonomy_ports=frame([(c, p) for c in ("gen", "load") for p in ("home", "hub")], S.TAXONOMY_PORTS_SCHEMA),
        models=frame([("lib", i, *m) for i, m in enumerate(MODELS)], S.MODELS_SCHEMA).coalesce(1),
        components=frame(components, S.COMPONENTS_SCHEMA).coalesce(1),
        connections=frame(connections, S.CONNECTIONS_SCHEMA).coalesce(1),
        catalogs=frame([(c, c, "t") for c in "ab"], S.CATALOGS_SCHEMA).coalesce(1),
        metrics=frame(metrics, S.METRICS_SCHEMA).coalesce(1),
        terms=frame(terms, S.TERMS_SCHEMA).coalesce(1),
        references=frame([(i, f"{c}.{m}") for i, (c, m) in enumerate(REFERENCES)], S.REFERENCES_SCHEMA).coalesce(1),
    )


def rows(view):
    return sorted((tuple(r) for r in view.withColumn("metric_value", F.round("metric_value", 6)).collect()), key=str)


CASES = [(1, 1, 5, Limits()), (2, 1, 5, SPLIT), (3, 0, 5, Limits()), (4, 0, 5, SPLIT), (7, 1, 99, Limits())]


@pytest.mark.parametrize("seed, step_hours, split_block, limits", CASES)
def test_view_equals_brute_force(spark, seed, step_hours, split_block, limits):
    """Step 0 puts all time indexes on one date, so means need both aggregation stages.
    A calendar of one block is a range test."""
    data = make(seed, step_hours, split_block)
    simulation, calendar, components, connections = data
    expected = brute_view(simulation, calendar, TERMS, MODELS, components, connections, REFERENCES)
    assert rows(build_view(as_study(spark, *data), limits)) == expected


def test_colliding_fingerprints_fall_back_to_texts(spark, monkeypatch):
    data = make(5, 1)
    study = as_study(spark, *data)
    expected = rows(build_view(study))
    monkeypatch.setattr(plan.F, "xxhash64", lambda *columns: F.lit(7).cast("long"))
    assert rows(build_view(study)) == expected


def test_naive_form_agrees(spark):
    data = make(6, 1)
    simulation, calendar, components, connections = data
    expected = brute_view(simulation, calendar, TERMS, MODELS, components, connections, REFERENCES)
    assert rows(naive_view(as_study(spark, *data))) == expected
