import json
import threading
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests import two_bus as fixture
from viewloom import (
    append_view,
    load_study,
    read_simulation,
    read_view,
    write_filtered,
    write_granular,
    write_structure,
    write_view,
)
from viewloom import schemas as S
from viewloom.sources import documents as docs
from viewloom.sources.study import read_catalogs, read_view_config
from viewloom.staging import released, stage, stage_measured, staging_root


def document(spark, tmp_path, root, body, shape):
    path = tmp_path / f"{root}.json"
    path.write_text(json.dumps({root: body}))
    return docs.read_document(spark, str(path), shape)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_simulation_must_be_parquet(spark):
    with pytest.raises(ValueError, match="'.*simulation_table--invalid.csv' is not a parquet file"):
        read_simulation(spark, "/x/simulation_table--invalid.csv")


def test_simulation_types_are_aligned(spark, two_bus, tmp_path):
    odd = two_bus.simulation.withColumns(
        {
            "block": F.col("block").cast("int"),
            "absolute_time_index": F.col("absolute_time_index").cast("int"),
            "scenario_index": F.col("scenario_index").cast("double"),
            "value": F.col("value").cast("float"),
        }
    )
    path = str(tmp_path / "simulation_table.parquet")
    odd.write.parquet(path)
    read = read_simulation(spark, path)
    assert [f.dataType for f in read.schema] == [f.dataType for f in S.SIMULATION_SCHEMA]
    assert read.exceptAll(two_bus.simulation.select(*read.columns)).isEmpty()


def test_partitioned_simulation_directory(spark, two_bus, tmp_path):
    path = str(tmp_path / "simulation")
    two_bus.simulation.write.partitionBy("output").parquet(path)
    read = read_simulation(spark, path)
    assert read.columns == list(S.SIMULATION_COLUMNS)
    assert read.filter(F.col("output") == "p").count() == 72


def test_simulation_columns_are_checked(spark, two_bus, tmp_path):
    path = str(tmp_path / "simulation_table.parquet")
    two_bus.simulation.drop("value").write.parquet(path)
    with pytest.raises(ValueError, match="column_missing: simulation: value"):
        read_simulation(spark, path)


def test_taxonomy(spark, tmp_path):
    taxonomy, ports = docs.taxonomy_tables(
        document(spark, tmp_path, "taxonomy", fixture.TAXONOMY, docs.TAXONOMY_DOCUMENT)
    )
    assert taxonomy.select("taxonomy_id").distinct().first()[0] == "my_taxonomy"
    assert rows(taxonomy.select("category_id")) == [
        (c,) for c in ("balance", "consumption", "coupling", "link", "production", "storage")
    ]
    assert rows(ports.filter("category_id = 'link'").select("port_id")) == [("p0_port",), ("p1_port",)]


def test_library(spark, tmp_path):
    models = docs.model_table(document(spark, tmp_path, "library", fixture.LIBRARY, docs.LIBRARY_DOCUMENT))
    assert models.filter("taxonomy_category = 'consumption'").select("library_id", "model_id").orderBy("pos").collect() == [
        ("pypsa_models", "load"), ("pypsa_models", "store"),
    ]


def test_system(spark, tmp_path):
    components, connections = docs.system_tables(
        document(spark, tmp_path, "system", fixture.SYSTEM, docs.SYSTEM_DOCUMENT)
    )
    assert components.count() == 7 and connections.count() == 6
    assert components.columns == ["component", "model_ref"]


def test_catalog(spark, tmp_path):
    body = dict(fixture.CATALOG)
    body["metrics-definition"] = [
        fixture.metric("A", ("x", "old", "p")),
        fixture.metric("B", ("x", "o", None), ("y", "q", ["p", "q"]), time_operator="avg"),
        fixture.metric("A", ("x", "new", "p"), terms_operator="avg"),
    ]
    read = document(spark, tmp_path, "catalog", body, docs.CATALOG_DOCUMENT).withColumn("catalog_key", F.lit("file"))
    catalogs, metrics, terms = docs.catalog_tables(read)
    assert rows(catalogs) == [("file", "test_example_pypsa", "my_taxonomy")]
    assert rows(metrics) == [("file", "A", "avg", "sum"), ("file", "B", "sum", "avg")]
    assert rows(terms) == [
        ("file", "A", 0, "x", "new", ["p"]),
        ("file", "B", 0, "x", "o", None),
        ("file", "B", 1, "y", "q", ["p", "q"]),
    ]


def test_missing_root_key(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps({"catalogue": {}}))
    with pytest.raises(ValueError, match="missing the 'catalog' key"):
        docs.read_document(spark, str(path), docs.CATALOG_DOCUMENT)


def test_catalogs_are_read_at_once_under_their_files_names(spark, tmp_path):
    for name in ("one", "two words"):
        body = {**fixture.CATALOG, "metrics-definition": [fixture.metric("A", ("x", name, "p"))]}
        (tmp_path / f"{name}.json").write_text(json.dumps({"catalog": body}))
    terms = docs.catalog_tables(read_catalogs(spark, str(tmp_path), ["two words", "one", "one"]))[2]
    assert rows(terms.select("catalog_key", "output_id")) == [("one", "one"), ("two words", "two words")]


def view_config(spark, tmp_path, **changes):
    return read_view_config(document(spark, tmp_path, "view", {**fixture.view("a.X"), **changes}, docs.VIEW_DOCUMENT))


def test_view_config(spark, tmp_path):
    config = view_config(spark, tmp_path)
    assert (config.id, config.calendar_id, config.location_category) == ("view_area", "calendar_file", "balance")
    assert (config.time_grain, config.catalog_ids) == ("hour", ["catalog"])
    assert view_config(spark, tmp_path, aggregation=[]).time_grain is None


def test_first_scope_entry_that_gives_a_value_counts(spark, tmp_path):
    scope = [{"calendar": ""}, {"taxonomy-category": "x"}, {"calendar": "one", "taxonomy-category": "y"}, {"calendar": "two"}]
    config = view_config(spark, tmp_path, scope=scope)
    assert (config.calendar_id, config.location_category) == ("one", "x")


def test_faulty_view_configs(spark, tmp_path):
    with pytest.raises(ValueError, match="scope_category"):
        view_config(spark, tmp_path, scope=[{"calendar": "c"}])
    with pytest.raises(ValueError, match="scope_calendar"):
        view_config(spark, tmp_path, scope=[{"taxonomy-category": "c"}])
    with pytest.raises(ValueError, match="time_grain: view_area: minute"):
        view_config(spark, tmp_path, aggregation=[{"time": "minute"}])


def test_system_may_come_as_tables(spark, two_bus_dir, two_bus):
    study = load_study(spark, str(two_bus_dir), two_bus.components, two_bus.connections)
    assert study.components is two_bus.components and study.connections is two_bus.connections


def test_intermediate_tables_can_be_kept(spark, two_bus, tmp_path):
    from viewloom import aggregate_terms, filter_by_calendar, study_structure

    filtered = write_filtered(filter_by_calendar(two_bus.simulation, two_bus.calendar), str(tmp_path / "filtered"))
    assert filtered.columns == list(S.FILTERED_COLUMNS) and filtered.count() == 121
    structure = write_structure(study_structure(two_bus), str(tmp_path / "structure"))
    assert structure.count() == 6
    granular = write_granular(aggregate_terms(filtered, structure), str(tmp_path / "granular"))
    assert granular.count() == 97
    folders = list((tmp_path / "granular").glob("**/metric_id=PROD"))
    assert len(folders) == 1 and len(list(folders[0].glob("*.parquet"))) == 1


def test_view_can_be_appended_to(spark, tmp_path):
    one = spark.createDataFrame([("M", "l", "", None, None, 1.0)], "metric_id string, metric_location string, breakdown_properties string, view_date timestamp_ntz, scenario long, metric_value double")
    path = str(tmp_path / "view.parquet")
    append_view(one, path)
    append_view(one, path)
    assert read_view(spark, path).count() == 2


VIEW = "metric_id string, metric_location string, breakdown_properties string, view_date timestamp_ntz, scenario long, metric_value double"


def test_a_run_can_be_appended_again(spark, tmp_path):
    """The same run replaces its rows, another adds, and the run is no column of the view."""
    view = lambda *values: spark.createDataFrame([("M", "l", "", None, 1, v) for v in values], VIEW)
    values = lambda: sorted(r["metric_value"] for r in read_view(spark, path).collect())
    path = write_view(view(1.0), str(tmp_path), run="2024-01-01")
    append_view(view(2.0, 3.0), path, run="2024-02")
    append_view(view(2.0, 3.0), path, run="2024-02")
    assert values() == [1.0, 2.0, 3.0] and read_view(spark, path).columns == list(S.VIEW_COLUMNS)
    append_view(view(4.0), path, run="2024-02")
    append_view(view(5.0), path, run="b=/c")
    assert values() == [1.0, 4.0, 5.0]
    with pytest.raises(ValueError, match="kept by run"):
        append_view(view(6.0), path)
    plain = write_view(view(1.0), str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not kept by run"):
        append_view(view(6.0), plain, run="x")
    with pytest.raises(ValueError, match="id"):
        append_view(view(6.0), path, run="")
    assert values() == [1.0, 4.0, 5.0]


def test_a_failed_run_leaves_the_view_as_it_was(spark, tmp_path):
    view = spark.createDataFrame([("M", "l", "", None, 1, 1.0)], VIEW)
    path = write_view(view, str(tmp_path), run="a")
    broken = view.withColumn("metric_value", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        append_view(broken, path, run="a")
    assert [r["metric_value"] for r in read_view(spark, path).collect()] == [1.0]


def row_groups(folder):
    files = list(folder.glob("**/*.parquet"))
    metadata = [pq.ParquetFile(f).metadata for f in files if f.is_file()]
    return [sorted((m.row_group(i).num_rows for i in range(m.num_row_groups)), reverse=True) for m in metadata]


def test_every_written_table_has_row_groups_of_64_000_rows(spark, tmp_path):
    """In the footers: full groups, and what is left."""
    rows = spark.range(0, 150_000, numPartitions=1)
    view = rows.select(
        F.lit("M").alias("metric_id"), F.col("id").cast("string").alias("metric_location"), F.lit("").alias("breakdown_properties"),
        F.lit(None).cast("timestamp_ntz").alias("view_date"), F.lit(0).cast("long").alias("scenario"), F.rand(1).alias("metric_value"),
    )
    full = [[64_000, 64_000, 22_000]]
    assert row_groups(Path(write_view(view, str(tmp_path / "a")))) == full
    assert row_groups(Path(write_view(view, str(tmp_path / "b"), run="x"))) == full
    append_view(view, str(tmp_path / "c"))
    assert row_groups(tmp_path / "c") == full
    for write in (write_filtered, write_structure):
        write(view, str(tmp_path / write.__name__))
        assert row_groups(tmp_path / write.__name__) == full
    staged = stage(view, "groups")
    assert row_groups(Path(staged.inputFiles()[0].removeprefix("file:")).parent) == full


def test_scopes_belong_to_their_thread(spark):
    """A table staged by one thread outlives the scope that another has open."""
    opened, staged = threading.Event(), threading.Event()

    def other():
        with released(spark):
            opened.set()
            staged.wait(60)

    thread = threading.Thread(target=other)
    thread.start()
    opened.wait(60)
    table = stage(spark.range(5), "mine")
    with released(spark):
        inner = stage(spark.range(3), "inner")
        assert inner.count() == 3
    staged.set()
    thread.join()
    assert table.count() == 5
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        inner.count()


def test_sizes_come_with_the_write(spark):
    table, measured = stage_measured(spark.range(10), "sizes", n=F.count("*"), most=F.max("id"), none=F.sum(F.lit(None).cast("long")))
    assert measured == {"n": 10, "most": 9, "none": None} and table.columns == ["id"]


def test_staged_tables_live_below_the_checkpoint_folder(spark):
    staged = stage(spark.range(3), "numbers")
    assert staged.count() == 3
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert all(staging_root(spark) in path for path in staged.inputFiles())


def test_cluster_without_checkpoint_folder_is_refused():
    class Conf:
        def get(self, name, default=None):
            return {"spark.master": "yarn"}.get(name, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging_root(Session())
