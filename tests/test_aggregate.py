import pytest
from pyspark.sql import functions as F

from viewloom import Limits, aggregate_terms, aggregate_time
from viewloom import schemas as S
from viewloom.operators import aggregate
from viewloom.operators.aggregate import Links, matched_facts, partial_values

FILTERED = (
    "component string, output string, absolute_time_index long, block_time_index long, scenario_index long, "
    "value double, granular_date string, block string, basis_status string"
)
STRUCTURE = (
    "metric_id string, component string, metric_location string, breakdown_properties string, output string, "
    "weight_output_id string, terms_operator string"
)
GRANULAR = (
    "metric_id string, metric_location string, breakdown_properties string, absolute_time_index long, "
    "scenario long, granular_metric_value double, granular_date string"
)


def filtered(spark, rows):
    return spark.createDataFrame([(c, o, t, t, s, v, d, "1", "BASIC") for c, o, t, s, v, d in rows], FILTERED)


def structure(spark, operator, *rows):
    return spark.createDataFrame([("M", c, loc, "", o, "1", operator) for c, loc, o in rows], STRUCTURE)


@pytest.mark.parametrize("operator, value", [("sum", 5.0), ("avg", 2.5)])
@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_bytes=0)])
def test_terms(spark, operator, value, limits):
    facts = filtered(spark, [("c1", "p", 0, 0, 2.0, "d"), ("c2", "p", 0, 0, 3.0, "d"), ("c3", "p", 0, 0, 9.0, "d")])
    rows = aggregate_terms(facts, structure(spark, operator, ("c1", "loc", "p"), ("c2", "loc", "p")), limits)
    assert rows.columns == list(S.GRANULAR_COLUMNS)
    assert [tuple(r) for r in rows.collect()] == [("M", "loc", "", 0, 0, value, "d")]


def test_repeated_structure_rows_count_twice(spark):
    facts = filtered(spark, [("c1", "p", 0, 0, 2.0, "d")])
    rows = aggregate_terms(facts, structure(spark, "sum", ("c1", "loc", "p"), ("c1", "loc", "p")))
    assert [r["granular_metric_value"] for r in rows.collect()] == [4.0]


def test_mean_is_over_rows_not_over_terms(spark):
    facts = filtered(spark, [("c1", "p", 0, 0, 1.0, "d"), ("c1", "p", 0, 0, 2.0, "d"), ("c2", "p", 0, 0, 6.0, "d")])
    rows = aggregate_terms(facts, structure(spark, "avg", ("c1", "loc", "p"), ("c2", "loc", "p")))
    assert [r["granular_metric_value"] for r in rows.collect()] == [3.0]


@pytest.mark.parametrize("operator, value", [("sum", 0.0), ("avg", None)])
def test_only_nulls(spark, operator, value):
    facts = filtered(spark, [("c1", "p", 0, 0, None, "d")])
    rows = aggregate_terms(facts, structure(spark, operator, ("c1", "loc", "p"), ("c2", "loc", "p")))
    assert {tuple(r) for r in rows.collect()} == {
        ("M", "loc", "", 0, 0, value, "d"),
        ("M", "loc", "", None, None, value, None),  # c2 has no rows
    }


def test_first_date_that_is_given(spark):
    facts = filtered(spark, [("c1", "p", 0, 0, 1.0, None), ("c1", "p", 0, 0, 1.0, "d")])
    rows = aggregate_terms(facts, structure(spark, "sum", ("c1", "loc", "p")))
    assert [(r["granular_metric_value"], r["granular_date"]) for r in rows.collect()] == [(2.0, "d")]


def test_time(spark):
    granular = spark.createDataFrame(
        [("M", "loc", "", 0, 0, 10.0, "d"), ("M", "loc", "", 1, 0, 20.0, "d"), ("M", "loc", "", 2, 1, None, "e")],
        GRANULAR,
    )
    rows = aggregate_time(granular)
    assert rows.columns == list(S.VIEW_COLUMNS)
    assert {tuple(r) for r in rows.collect()} == {
        ("M", "loc", "", "d", 0, 30.0),
        ("M", "loc", "", "e", 1, 0.0),
    }
    with pytest.raises(NotImplementedError):
        aggregate_time(granular, "avg")


LINKS = "_link long, component string, output string, group_id long, is_avg boolean, copies long, _mask int, _bit long"


def fact_plan(spark, two_bus, masks, wide, limits=Limits()):
    from tests.plans import formatted
    from viewloom import filter_by_calendar

    rows = spark.createDataFrame([(0, "generator_A1", "p", 1, False, 1, 0, 1)], LINKS)
    links = Links(rows, ["group_id"], masks, wide)
    matched = matched_facts(filter_by_calendar(two_bus.simulation, two_bus.calendar), links, limits)
    grain = {"scenario": F.col("scenario"), "view_date": F.col("granular_date")}
    return formatted(partial_values(matched, links, grain))


@pytest.mark.parametrize("masks", [1, 4])
def test_facts_are_read_once_and_not_shuffled_by_the_join(spark, two_bus, masks):
    plan = fact_plan(spark, two_bus, masks, wide=False)
    tree = plan.split("(1) ")[0]
    assert tree.count("Scan parquet") == 1 and tree.count("Exchange hashpartitioning") <= 1
    assert "BroadcastHashJoin Inner" in tree and "Expand" not in tree and "Generate" not in tree
    assert plan.count("bit_or(") >= masks
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert not any("basis_status" in line or "block_time_index" in line for line in schemas)


def test_only_wide_groups_repeat_their_facts(spark, two_bus):
    tree = fact_plan(spark, two_bus, 1, wide=True).split("(1) ")[0]
    assert tree.count("Scan parquet") == 1 and "Generate" in tree and "Expand" not in tree


def test_one_scan_past_the_budget(spark, two_bus):
    tree = fact_plan(spark, two_bus, 1, False, Limits(0)).split("(1) ")[0]
    assert "SortMergeJoin Inner" in tree and tree.count("Scan parquet") == 1


@pytest.mark.parametrize("mask_links, masks", [(64, 4), (3, 4), (2, 2), (1, 1)])
@pytest.mark.parametrize("limits", [Limits(), Limits(0)])
def test_links_without_facts_whatever_the_size_of_their_group(spark, monkeypatch, mask_links, masks, limits):
    """Groups of 1 to 9 links, of which every third has no facts: narrow, wide and mixed."""
    monkeypatch.setattr(aggregate, "MASK_LINKS", mask_links)
    monkeypatch.setattr(aggregate, "MASKS", masks)
    links = [(f"c{g}_{i}", f"loc{g}", "p") for g in range(1, 10) for i in range(g)]
    met = [(c, loc) for n, (c, loc, _) in enumerate(links) if n % 3]
    facts = filtered(spark, [(c, "p", t, s, 1.0, f"d{t}") for c, _ in met for t in range(2) for s in range(2)])
    rows = aggregate_terms(facts, structure(spark, "sum", *links), limits).collect()
    want = {}
    for c, loc in met:
        for t in range(2):
            for s in range(2):
                want[loc, t, s] = want.get((loc, t, s), 0.0) + 1.0
    for c, loc, _ in links:
        if (c, loc) not in met:
            want[loc, None, None] = 0.0
    got = {(r["metric_location"], r["absolute_time_index"], r["scenario"]): r["granular_metric_value"] for r in rows}
    assert got == want and len(rows) == len(want)


def test_a_hundred_thousand_links_of_one_group_are_not_numbered(spark):
    """A wide group has no window; its links without facts are found all the same."""
    links = spark.range(100_000).select(
        F.lit("M").alias("metric_id"), F.concat(F.lit("c"), F.col("id")).alias("component"), F.lit("loc").alias("metric_location"),
        F.lit("").alias("breakdown_properties"), F.lit("p").alias("output"), F.lit("1").alias("weight_output_id"),
        F.lit("avg").alias("terms_operator"),
    )
    facts = filtered(spark, [("c1", "p", 0, 0, 2.0, "d"), ("c70000", "p", 0, 0, 4.0, "d")])
    rows = aggregate_terms(facts, links).collect()
    assert {tuple(r) for r in rows} == {("M", "loc", "", 0, 0, 3.0, "d"), ("M", "loc", "", None, None, None, None)}


@pytest.mark.parametrize("one_plan", [True, False])
def test_outputs_reach_the_scan(spark, two_bus, two_bus_dir, monkeypatch, one_plan):
    from tests.plans import formatted
    from viewloom import build_view, filter_by_calendar, study_structure
    from viewloom.operators import aggregate

    plans = []
    plain = aggregate.partial_values
    monkeypatch.setattr(aggregate, "partial_values", lambda *a: plans.append(formatted(plain(*a))) or plain(*a))
    if one_plan:
        build_view(two_bus)
    else:
        aggregate_terms(filter_by_calendar(two_bus.simulation, two_bus.calendar), study_structure(two_bus))
    assert len(plans) == 1
    assert "Python" not in plans[0] and "Cartesian" not in plans[0] and "NestedLoop" not in plans[0]
    assert "GreaterThanOrEqual(output,active_load)" in plans[0] and "LessThanOrEqual(output,p1_port.flow)" in plans[0]
    assert ("In(output, [" in plans[0]) == one_plan
