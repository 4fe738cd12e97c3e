"""Study documents (taxonomy, library, system, catalogs, view) as nested tables.

A document is one nested row with a fixed schema, read from JSON; the tables are exploded
from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.functions import or_empty, parse_ports
from viewloom.operators.references import latest_definitions
from viewloom.sources.large_documents import array_items, json_items
from viewloom.staging import file_system

#: Bytes from which a system document is read in several tasks.
LARGE_BYTES = 64 << 20

_ITEMS = "array<struct<id: string>>"

# The document shapes, reduced to the fields that tables are made of.
TAXONOMY_DOCUMENT = f"""
taxonomy struct<id: string, description: string, categories: array<struct<
  id: string, `parent-category`: string, variables: {_ITEMS}, parameters: {_ITEMS}, ports: {_ITEMS},
  constraints: {_ITEMS}, `extra-outputs`: {_ITEMS}, properties: {_ITEMS}>>>"""
LIBRARY_DOCUMENT = f"""
library struct<id: string, description: string, `port-types`: {_ITEMS},
  models: array<struct<id: string, `taxonomy-category`: string>>>"""
COMPONENT = "id: string, model: string"
CONNECTION = "component1: string, port1: string, component2: string, port2: string"
SYSTEM_DOCUMENT = f"""
system struct<id: string, components: array<struct<{COMPONENT}>>, connections: array<struct<{CONNECTION}>>>"""
CATALOG_DOCUMENT = """
catalog struct<id: string, taxonomy: string, location: struct<`taxonomy-category`: string>,
  `metrics-definition`: array<struct<id: string,
    terms: array<struct<`taxonomy-category`: string, `output-id`: string, `location-ports`: string,
      `weight-output-id`: string>>,
    `terms-operator`: string, `time-operator`: string, `breakdown-property`: string, filter: array<string>>>>"""
VIEW_DOCUMENT = f"""
view struct<id: string, scope: array<struct<`taxonomy-category`: string, calendar: string>>,
  aggregation: array<struct<time: string>>, catalog: {_ITEMS}, metrics: {_ITEMS}>"""


def read_document(spark: SparkSession, path: str, shape: str) -> DataFrame:
    """One document as one row with the fields below the root that ``shape`` names first."""
    return read_documents(spark, [path], shape, "_name").drop("_name")


def read_documents(spark: SparkSession, paths: list[str], shape: str, key: str) -> DataFrame:
    """Documents in one read, each a row with ``key``, its file's name without extension."""
    root = shape.split(maxsplit=1)[0]
    reader = spark.read.schema(shape).option("multiLine", True).option("mode", "FAILFAST")
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    documents = reader.json(paths).withColumn(key, F.url_decode(name))
    rootless = documents.filter(F.col(root).isNull()).select(key).limit(1).collect()
    if rootless or documents.isEmpty():
        raise ValueError(f"missing the '{root}' key at the root: {rootless[0][0] if rootless else paths}")
    return documents.select(key, f"{root}.*")


def headers(document: DataFrame) -> DataFrame:
    """(id, description) of taxonomy or library documents; no description reads as empty."""
    return document.select("id", or_empty(F.col("description")).alias("description"))


def taxonomy_tables(document: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(taxonomy_id, category_id, parent_category) and (category_id, port_id)."""
    categories = document.select(F.col("id").alias("taxonomy_id"), F.explode("categories").alias("c"))
    taxonomy = categories.select(
        "taxonomy_id", F.col("c.id").alias("category_id"), F.col("c.parent-category").alias("parent_category")
    )
    ports = categories.select(F.col("c.id").alias("category_id"), F.explode("c.ports").alias("p")).select(
        "category_id", F.col("p.id").alias("port_id")
    )
    return taxonomy, ports


def model_table(document: DataFrame) -> DataFrame:
    return document.select(F.col("id").alias("library_id"), F.posexplode("models").alias("pos", "m")).select(
        "library_id",
        F.col("pos").cast("long").alias("pos"),
        F.col("m.id").alias("model_id"),
        F.col("m.taxonomy-category").alias("taxonomy_category"),
    )


def system_tables(document: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(component, model_ref) and (component1, port1, component2, port2)."""
    components = document.select(F.explode("components").alias("c")).select(
        F.col("c.id").alias("component"), F.col("c.model").alias("model_ref")
    )
    connections = document.select(F.explode("connections").alias("c")).select("c.*")
    return components, connections


def read_system(spark: SparkSession, path: str, large: int = LARGE_BYTES) -> tuple[DataFrame, DataFrame]:
    """(component, model_ref) and (component1, port1, component2, port2) of a system document.

    A document of ``large`` bytes or more is read in several tasks; smaller ones are parsed in one.
    """
    files, where = file_system(spark, path)
    if files.getFileStatus(where).getLen() < large:
        return system_tables(read_document(spark, path, SYSTEM_DOCUMENT))
    items = json_items(spark, path)
    components = array_items(items, "components", COMPONENT)
    return (
        components.select(F.col("id").alias("component"), F.col("model").alias("model_ref")),
        array_items(items, "connections", CONNECTION),
    )


def catalog_tables(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalogs, metrics and terms of documents that carry their ``catalog_key``.

    The last definition of a metric id in a catalog wins.
    """
    catalogs = documents.select("catalog_key", F.col("id").alias("catalog_id"), F.col("taxonomy").alias("taxonomy_id"))
    defined = documents.select("catalog_key", F.posexplode("metrics-definition").alias("pos", "m")).select(
        "catalog_key", F.col("m.id").alias("metric_id"), "pos", "m"
    )
    latest = latest_definitions(defined, ["catalog_key", "metric_id"], "pos")
    metrics = latest.select(
        "catalog_key",
        "metric_id",
        F.col("m.terms-operator").alias("terms_operator"),
        F.col("m.time-operator").alias("time_operator"),
    )
    without = F.raise_error(F.concat(F.lit("missing_field: terms of "), "catalog_key", F.lit("."), "metric_id"))
    given = F.when(F.col("m.terms").isNull(), without).otherwise(F.col("m.terms"))
    terms = latest.select("catalog_key", "metric_id", F.posexplode(given).alias("term_ord", "t")).select(
        "catalog_key",
        "metric_id",
        "term_ord",
        F.col("t.taxonomy-category").alias("taxonomy_category"),
        F.col("t.output-id").alias("output_id"),
        parse_ports(F.col("t.location-ports")).alias("location_ports"),
    )
    return catalogs, metrics, terms


def reference_table(document: DataFrame) -> DataFrame:
    return document.select(F.posexplode("metrics").alias("pos", "m")).select(
        F.col("pos").cast("long").alias("pos"), F.col("m.id").alias("reference")
    )
