"""The lineitem study as a study directory: parquet tables, a calendar in CSV, documents in JSON."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import viewloom as vl
from studies import tables as t
from viewloom.sources import documents as docs
from viewloom.staging import file_system, new_folder


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    files, where = file_system(spark, path)
    out = files.create(where)
    out.write(bytearray(text, "utf-8"))
    out.close()


def _documents() -> dict[str, dict]:
    categories = [
        {"id": c, "ports": [{"id": p} for p in ports]} for c, ports in t.CATEGORY_PORTS.items()
    ]
    models = [{"id": model, "taxonomy-category": category} for _, _, model, category in t.MODELS]
    catalogs: dict[str, dict[str, dict]] = {}
    for catalog, metric, _, category, output, ports in t.LINEITEM_TERMS:
        operator = "avg" if metric.endswith("_AVG") else "sum"
        found = catalogs.setdefault(catalog, {}).setdefault(
            metric, {"id": metric, "terms": [], "terms-operator": operator, "time-operator": "sum"}
        )
        ports = json.dumps(ports) if ports else None
        found["terms"].append({"taxonomy-category": category, "output-id": output, "location-ports": ports})
    view = {
        "id": "lineitem",
        "scope": [{"calendar": ""}, {"taxonomy-category": "location"}, {"calendar": "days"}],
        "aggregation": [{"time": "day"}],
        "catalog": [{"id": c} for c in catalogs],
        "metrics": [{"id": r} for r in t.LINEITEM_REFERENCES],
    }
    documents = {
        "taxonomy": {"taxonomy": {"id": "tax", "categories": categories}},
        "library": {"library": {"id": "lib", "models": models}},
        "view_config": {"view": view},
    }
    for catalog, metrics in catalogs.items():
        body = {"id": f"{catalog} inside", "taxonomy": "tax", "metrics-definition": list(metrics.values())}
        documents[f"catalogs/{catalog}"] = {"catalog": body}
    return documents


def write_lineitem_study(spark: SparkSession, sf_dir: str) -> str:
    """Writes the study below the staging root and returns its directory."""
    path = f"{new_folder(spark, 'study')}/lineitem"
    t.lineitem_simulation(spark, sf_dir).write.parquet(f"{path}/simulation_table.parquet")
    t.lineitem_calendar(spark).coalesce(1).write.option("header", True).csv(f"{path}/days.csv")
    t.lineitem_components(spark, sf_dir).write.parquet(f"{path}/components.parquet")
    t.lineitem_connections(spark, sf_dir).write.parquet(f"{path}/connections.parquet")
    for name, document in _documents().items():
        _write_text(spark, f"{path}/{name}.json", json.dumps(document))
    return path


def write_system(spark: SparkSession, sf_dir: str) -> str:
    """The lineitem study's system as one document, ``system.json``; components and connections stay rows until written."""
    path = f"{new_folder(spark, 'system')}/system.json"
    components = t.lineitem_components(spark, sf_dir).select(
        F.lit(1).alias("part"), F.to_json(F.struct(F.col("component").alias("id"), F.col("model_ref").alias("model"))).alias("item")
    )
    connections = t.lineitem_connections(spark, sf_dir)
    connections = connections.select(F.lit(3).alias("part"), F.to_json(F.struct(*connections.columns)).alias("item"))
    frame = ['{"system": {"id": "lineitem", "components": [{"id": "first"}', '], "connections": [{"port1": "none"}', "]}}"]
    frame = spark.createDataFrame(list(zip((0, 2, 4), frame)), "part int, item string")
    items = components.unionByName(connections).withColumn("item", F.concat(F.lit(","), "item"))
    lines = items.unionByName(frame).repartitionByRange("part").sortWithinPartitions("part").select("item")
    folder = f"{path}.parts"
    lines.coalesce(1).write.text(folder)
    files, where = file_system(spark, f"{folder}/part-*")
    files.rename(files.globStatus(where)[0].getPath(), file_system(spark, path)[1])
    return path


def file_system_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of a system document that is read in several tasks."""
    components, _ = docs.read_system(spark, write_system(spark, sf_dir), large=0)
    return components.filter("component <> 'first'")


def file_system_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port edges of a system document that is read in several tasks."""
    _, connections = docs.read_system(spark, write_system(spark, sf_dir), large=0)
    return vl.port_edges(connections)


def read_lineitem_study(spark: SparkSession, path: str) -> vl.Study:
    components, connections = (spark.read.parquet(f"{path}/{n}.parquet") for n in ("components", "connections"))
    return vl.load_study(spark, path, components, connections)


def file_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The simulation table as its reader returns it."""
    return read_lineitem_study(spark, write_lineitem_study(spark, sf_dir)).simulation


def file_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table read from parquet, filtered by the calendar read from CSV."""
    study = read_lineitem_study(spark, write_lineitem_study(spark, sf_dir))
    return vl.filter_by_calendar(study.simulation, study.calendar)


def file_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A study directory, loaded, checked, built, written and read back."""
    path = write_lineitem_study(spark, sf_dir)
    view = vl.run(read_lineitem_study(spark, path), f"{path}/results")
    return view.withColumn("metric_value", F.round("metric_value", 6))
