from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from viewloom import schemas as S
from viewloom import validate_study
from viewloom.operators import checks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_simulation_columns(two_bus):
    assert rows(checks.simulation_column_violations(two_bus.simulation.select(*reversed(S.SIMULATION_COLUMNS)))) == []
    renamed = two_bus.simulation.withColumnRenamed("value", "val")
    assert rows(checks.simulation_column_violations(renamed)) == [
        ("column_missing", "simulation", "value"),
        ("column_unknown", "simulation", "val"),
    ]
    assert rows(checks.filtered_column_violations(two_bus.simulation)) == [("column_missing", "filtered", "granular_date")]


def test_sound_study_passes(two_bus):
    validate_study(two_bus)


def test_wrong_taxonomy(two_bus):
    other = two_bus.catalogs.withColumn("taxonomy_id", F.lit("other"))
    with pytest.raises(ValueError, match="taxonomy_id: catalog: other"):
        validate_study(replace(two_bus, catalogs=other))


def test_unknown_category_also_in_unselected_metrics(two_bus):
    metric = F.col("metric_id") == "INSTALLED_PROD_CAPACITY"
    terms = two_bus.terms.withColumn("taxonomy_category", F.when(metric, "nope").otherwise(F.col("taxonomy_category")))
    with pytest.raises(ValueError, match="unknown_category: catalog.INSTALLED_PROD_CAPACITY: nope"):
        validate_study(replace(two_bus, terms=terms))


def test_every_port_of_a_term_is_checked(two_bus):
    terms = two_bus.terms.withColumn(
        "location_ports",
        F.when(F.col("metric_id") == "CORRIDOR", F.array(F.lit("p0_port"), F.lit("p9_port"))).otherwise(
            F.col("location_ports")
        ),
    )
    with pytest.raises(ValueError, match="unknown_port: catalog.CORRIDOR: link.p9_port"):
        validate_study(replace(two_bus, terms=terms))


def test_calendar_is_checked(two_bus):
    gapped = two_bus.calendar.filter("absolute_time_index <> 3")
    with pytest.raises(ValueError, match="calendar_index"):
        validate_study(replace(two_bus, calendar=gapped))


def test_definitions(spark):
    metrics = spark.createDataFrame(
        [("a", "X", "sum", "sum"), ("a", "Y", "max", None), ("a", None, "avg", "avg")], S.METRICS_SCHEMA
    )
    terms = spark.createDataFrame([("a", "X", 0, None, "p", None), ("a", "X", 1, "gen", None, None)], S.TERMS_SCHEMA)
    assert rows(checks.definition_violations(metrics, terms)) == [
        ("missing_field", "a", "metric_id"),
        ("missing_field", "a.X", "output_id"),
        ("missing_field", "a.X", "taxonomy_category"),
        ("missing_field", "a.Y", "terms"),
        ("unknown_operator", "a.Y", "terms_operator max"),
        ("unknown_operator", "a.Y", "time_operator"),
    ]


def test_models(spark):
    models = spark.createDataFrame(
        [("lib", 0, "m", None), ("lib", 1, "m", "gen"), ("lib", 2, "n", "gen"), ("lib", 3, "n", None)], S.MODELS_SCHEMA
    )
    requested = spark.createDataFrame([("m",), ("n",), ("o",)], "model_id string")
    assert rows(checks.model_violations(requested, models)) == [
        ("model", "n", "model without category"),
        ("model", "o", "unknown model"),
    ]


def test_message_is_bounded(spark):
    many = spark.range(1000).select(F.lit("r").alias("rule"), F.col("id").cast("string").alias("subject"), F.lit("d").alias("detail"))
    with pytest.raises(KeyError) as error:
        checks.assert_clean(many, KeyError)
    assert str(error.value).count("r: ") == checks.SHOWN and "1000 violations in all" in str(error.value)
