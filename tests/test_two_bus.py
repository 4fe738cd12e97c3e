"""End to end on the two-bus study."""

import json
import logging
import shutil
from dataclasses import replace
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from viewloom import Limits, build_view, load_study, read_view, run, study_structure
from viewloom.schemas import VIEW_COLUMNS

DATES = [datetime(2025, 1, 1) + timedelta(hours=t) for t in range(1, 25)]


def references(spark, *names):
    return spark.createDataFrame(list(enumerate(names)), "pos long, reference string")


def at(view, metric_id, location):
    rows = view.filter((F.col("metric_id") == metric_id) & (F.col("metric_location") == location))
    return [(r["view_date"], r["metric_value"]) for r in rows.orderBy("view_date").collect()]


@pytest.fixture(scope="module")
def result(two_bus, tmp_path_factory):
    return run(two_bus, str(tmp_path_factory.mktemp("results")))


def test_view_columns_and_size(result):
    assert result.columns == list(VIEW_COLUMNS)
    assert result.count() == 97


def test_production(result):
    assert at(result, "PROD", "busA") == [(d, 2.0 * t) for t, d in enumerate(DATES, 1)]
    assert at(result, "PROD", "busB") == [(d, 100.0 - 2 * t) for t, d in enumerate(DATES, 1)]


def test_constant_load_is_one_row_without_date(result):
    assert at(result, "LOAD", "busA") == [(None, 100.0)]
    assert at(result, "LOAD", "busB") == []


def test_balance(result):
    assert at(result, "BALANCE", "busA") == [(d, 100.0 - 2 * t) for t, d in enumerate(DATES, 1)]
    assert at(result, "BALANCE", "busB") == [(d, 2.0 * t - 100) for t, d in enumerate(DATES, 1)]


def with_metric(study, metric_id, column, value):
    chosen = F.when(F.col("metric_id") == metric_id, F.lit(value).cast("string")).otherwise(F.col(column))
    return replace(study, metrics=study.metrics.withColumn(column, chosen))


@pytest.mark.parametrize(
    "column, value, error",
    [
        ("terms_operator", "max", ValueError),
        ("terms_operator", None, ValueError),
        ("time_operator", "avg", NotImplementedError),
        ("time_operator", None, NotImplementedError),
    ],
)
def test_unknown_and_absent_operators_are_refused(two_bus, column, value, error):
    with pytest.raises(error, match=f"{column}: catalog.PROD"):
        build_view(with_metric(two_bus, "PROD", column, value))


@pytest.mark.parametrize("extra, number", [("simulation_table_old.parquet", 2), (None, 0)])
def test_a_study_has_one_simulation_table(spark, two_bus_dir, tmp_path, extra, number):
    path = tmp_path / "study"
    shutil.copytree(two_bus_dir, path)
    if extra:
        shutil.copytree(path / "simulation_table.parquet", path / extra)
    else:
        (path / "simulation_table.parquet").rename(path / "table.parquet")
    with pytest.raises(ValueError, match=f"has {number} tables, not one"):
        load_study(spark, str(path))


def test_a_metric_without_terms_is_refused(spark, two_bus_dir, tmp_path):
    path = tmp_path / "study"
    shutil.copytree(two_bus_dir, path)
    catalog = json.loads((path / "catalogs" / "catalog.json").read_text())
    catalog["catalog"]["metrics-definition"][0]["terms"] = None
    (path / "catalogs" / "catalog.json").write_text(json.dumps(catalog))
    with pytest.raises(Exception, match="missing_field: terms of catalog.PROD"):
        build_view(load_study(spark, str(path)))


def test_a_run_leaves_only_its_view(spark, two_bus, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = {p.name for p in Path(root).iterdir()}
    view = run(two_bus, str(tmp_path / "results"))
    assert view.count() == 97
    assert {p.name for p in Path(root).iterdir()} == before


def test_structure_sizes(two_bus):
    sizes = {r["metric_id"]: r["n"] for r in study_structure(two_bus).groupBy("metric_id").agg(F.sum("copies").alias("n")).collect()}
    assert sizes == {"PROD": 3, "LOAD": 1, "BALANCE": 2}


def test_structure_rows(two_bus):
    rows = {
        (r["metric_id"], r["component"], r["metric_location"], r["output"], r["breakdown_properties"], r["weight_output_id"])
        for r in study_structure(two_bus).collect()
    }
    assert rows == {
        ("PROD", "generator_A1", "busA", "p", "", "1"),
        ("PROD", "generator_A2", "busA", "p", "", "1"),
        ("PROD", "generator_B1", "busB", "p", "", "1"),
        ("LOAD", "load_AL", "busA", "active_load", "", "1"),
        ("BALANCE", "link_link_AB", "busA", "p0_port.flow", "", "1"),
        ("BALANCE", "link_link_AB", "busB", "p1_port.flow", "", "1"),
    }


def test_unmatched_output_gives_zero_rows(spark, two_bus):
    study = replace(two_bus, references=references(spark, "catalog.INSTALLED_PROD_CAPACITY"))
    rows = {tuple(r) for r in build_view(study).collect()}
    assert rows == {
        ("INSTALLED_PROD_CAPACITY", bus, "", None, None, 0.0) for bus in ("busA", "busB")
    }


def test_several_ports_join_peers_in_port_order(spark, two_bus):
    study = replace(two_bus, references=references(spark, "catalog.CORRIDOR"))
    assert at(build_view(study), "CORRIDOR", "busA|busB") == [(d, 100.0 - 2 * t) for t, d in enumerate(DATES, 1)]


def test_repeated_reference_repeats_rows(spark, two_bus):
    study = replace(two_bus, references=references(spark, "catalog.LOAD", "catalog.PROD", "catalog.LOAD"))
    view = build_view(study)
    assert at(view, "LOAD", "busA") == [(None, 100.0)] * 2
    assert view.count() == 50


def test_unknown_metric_is_skipped_with_a_warning(spark, two_bus, caplog):
    study = replace(two_bus, references=references(spark, "catalog.NOPE", "catalog.LOAD"))
    with caplog.at_level(logging.WARNING):
        assert build_view(study).count() == 1
    assert "1 references are skipped, catalog.NOPE first" in caplog.text


def test_nothing_selected_gives_an_empty_view(spark, two_bus):
    view = build_view(replace(two_bus, references=references(spark, "catalog.NOPE")))
    assert view.columns == list(VIEW_COLUMNS) and view.isEmpty()


def test_unknown_catalog_raises(spark, two_bus):
    with pytest.raises(KeyError, match="other"):
        build_view(replace(two_bus, references=references(spark, "other.LOAD")))


def test_malformed_reference_raises(spark, two_bus):
    for bad in ("nodot", ".LOAD", "catalog."):
        with pytest.raises(ValueError, match="reference_format"):
            build_view(replace(two_bus, references=references(spark, bad)))


def test_time_mean_is_not_supported(spark, two_bus):
    with pytest.raises(NotImplementedError, match="avg"):
        build_view(replace(two_bus, metrics=two_bus.metrics.withColumn("time_operator", F.lit("avg"))))


def test_ambiguous_location_raises_for_selected_metrics_only(spark, two_bus):
    terms = two_bus.terms.withColumn(
        "taxonomy_category",
        F.when(F.col("metric_id") == "LOAD", "balance").otherwise(F.col("taxonomy_category")),
    )
    study = replace(two_bus, terms=terms)
    with pytest.raises(ValueError, match="several_peers: busA.p_balance_port"):
        build_view(study)
    assert build_view(replace(study, references=references(spark, "catalog.PROD"))).count() == 48


def test_missing_connection_raises(spark, two_bus):
    connections = two_bus.connections.filter("component2 <> 'generator_B1'")
    with pytest.raises(ValueError, match="no_peer: generator_B1"):
        build_view(replace(two_bus, connections=connections))


def test_shuffle_paths_give_the_same_view(two_bus, result):
    view = build_view(two_bus, Limits(broadcast_bytes=0))
    assert view.exceptAll(result).isEmpty() and result.exceptAll(view).isEmpty()


def test_written_view_reads_back(spark, two_bus, tmp_path, result):
    from viewloom import append_view, write_view

    path = write_view(build_view(two_bus), str(tmp_path))
    append_view(result, path)
    assert read_view(spark, path).count() == 2 * 97


def test_two_views_at_once(spark, two_bus, tmp_path, result):
    """Each thread's run removes what it staged itself, and nothing else."""
    from concurrent.futures import ThreadPoolExecutor

    def build(number):
        return sorted(map(str, run(two_bus, str(tmp_path / str(number))).collect()))

    with ThreadPoolExecutor(3) as pool:
        views = list(pool.map(build, range(3)))
    assert views[0] == views[1] == views[2] == sorted(map(str, result.collect()))


def test_few_actions_come_before_the_fact_pass(spark, two_bus, monkeypatch):
    """References, structure and groups are measured by the jobs that write them: three writes, the calendar, the
    outputs, and one more if references are skipped."""
    from pyspark.sql import DataFrame, DataFrameWriter

    from viewloom.operators import aggregate

    actions, before = [], []
    for kind, name in ((DataFrame, "collect"), (DataFrame, "first"), (DataFrame, "isEmpty"), (DataFrameWriter, "parquet")):
        for owner in {kind, *kind.__subclasses__()}:
            if name in vars(owner):
                plain = vars(owner)[name]
                monkeypatch.setattr(owner, name, lambda self, *a, _p=plain, _n=name, **k: actions.append(_n) or _p(self, *a, **k))
    plain = aggregate.partial_values
    monkeypatch.setattr(aggregate, "partial_values", lambda *a: before.append(len(actions)) or plain(*a))
    build_view(two_bus)
    assert before and before[0] <= 7, actions
