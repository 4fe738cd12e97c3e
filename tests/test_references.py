import pytest

from viewloom import get_metric, metric_references
from viewloom import schemas as S
from viewloom.operators.references import (
    judged_references,
    latest_definitions,
    malformed_references,
    skipped_references,
    unknown_catalogs,
    unknown_metrics,
)


def references(spark, *names):
    return spark.createDataFrame(list(enumerate(names)), S.REFERENCES_SCHEMA)


def test_first_dot_splits_and_catalogs_come_by_first_mention(spark):
    parsed = metric_references(references(spark, "b.X", "a.Y.Z", "b.W", "a.Y.Z"))
    ordered = parsed.orderBy("catalog_pos", "pos").select("catalog_key", "metric_id").collect()
    assert [tuple(r) for r in ordered] == [("b", "X"), ("b", "W"), ("a", "Y.Z"), ("a", "Y.Z")]


def test_malformed(spark):
    refs = references(spark, "a.X", "nodot", ".X", "a.", "", None, ".")
    assert sorted(r["pos"] for r in malformed_references(refs).collect()) == [1, 2, 3, 4, 5, 6]
    assert metric_references(refs).count() == 1


def test_last_definition_wins(spark):
    definitions = spark.createDataFrame(
        [("a", "X", 0, "sum"), ("a", "X", 7, "avg"), ("a", "X", 3, None), ("b", "X", 1, None)],
        "catalog_key string, metric_id string, pos int, op string",
    )
    latest = latest_definitions(definitions, ["catalog_key", "metric_id"], "pos")
    assert latest.columns == ["catalog_key", "metric_id", "pos", "op"]
    assert {tuple(r) for r in latest.collect()} == {("a", "X", 7, "avg"), ("b", "X", 1, None)}


@pytest.fixture(scope="module")
def metrics(spark):
    rows = [("a", "X", "sum", "sum"), ("a", "Y", "avg", "avg"), ("a", "V", "max", "sum"), ("a", "W", None, "sum"), ("a", "U", "sum", None)]
    return spark.createDataFrame(rows, S.METRICS_SCHEMA)


def test_unknown(spark, metrics):
    catalogs = spark.createDataFrame([("a", "a", "t")], S.CATALOGS_SCHEMA)
    refs = references(spark, "a.X", "a.Q", "z.X", "bad", "a.Y", "a.V", "a.W", "a.U")
    parsed = metric_references(refs)
    assert [r["pos"] for r in unknown_catalogs(parsed, catalogs).collect()] == [2]
    assert sorted(r["pos"] for r in unknown_metrics(parsed, metrics).collect()) == [1, 2]
    assert [tuple(r) for r in skipped_references(refs, catalogs, metrics).collect()] == [(1, "a.Q")]
    judged = {r["reference"]: r["problem"] for r in judged_references(refs, catalogs, metrics).collect()}
    assert judged == {
        "a.X": None,
        "a.Q": "unknown_metric",
        "z.X": "unknown_catalog",
        "bad": "reference_format",
        "a.Y": "time_operator",
        "a.V": "terms_operator",
        "a.W": "terms_operator",
        "a.U": "time_operator",
    }


def test_get_metric(metrics):
    assert get_metric(metrics, "a", "X").first()["terms_operator"] == "sum"
    with pytest.raises(ValueError, match="Catalog a does not define metric Z"):
        get_metric(metrics, "a", "Z")
