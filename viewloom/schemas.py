"""Column names and schemas of the tables the engine reads and produces."""

from __future__ import annotations

from pyspark.sql import types as T

# The column contracts of the data model.
SIMULATION_COLUMNS = (
    "block",
    "component",
    "output",
    "absolute_time_index",
    "block_time_index",
    "scenario_index",
    "value",
    "basis_status",
)
FILTERED_COLUMNS = (*SIMULATION_COLUMNS, "granular_date")
CALENDAR_COLUMNS = ("absolute_time_index", "block", "granular_date")
STRUCTURE_COLUMNS = (
    "metric_id",
    "component",
    "metric_location",
    "breakdown_properties",
    "output",
    "weight_output_id",
)
GRANULAR_COLUMNS = (
    "metric_id",
    "metric_location",
    "breakdown_properties",
    "absolute_time_index",
    "scenario",
    "granular_metric_value",
    "granular_date",
)
VIEW_COLUMNS = (
    "metric_id",
    "metric_location",
    "breakdown_properties",
    "view_date",
    "scenario",
    "metric_value",
)
OPERATORS = ("sum", "avg")
TIME_GRAINS = ("hour", "day", "week", "month", "year")

SIMULATION_SCHEMA = T.StructType(
    [
        T.StructField("block", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("output", T.StringType()),
        T.StructField("absolute_time_index", T.LongType()),
        T.StructField("block_time_index", T.LongType()),
        T.StructField("scenario_index", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("basis_status", T.StringType()),
    ]
)
# Dates stay zone-free so that the session time zone can never shift them.
CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("absolute_time_index", T.LongType()),
        T.StructField("block", T.StringType()),
        T.StructField("granular_date", T.TimestampNTZType()),
    ]
)

# Metadata tables.
TAXONOMY_SCHEMA = "taxonomy_id string, category_id string, parent_category string"
TAXONOMY_PORTS_SCHEMA = "category_id string, port_id string"
MODELS_SCHEMA = "library_id string, pos long, model_id string, taxonomy_category string"
COMPONENTS_SCHEMA = "component string, model_ref string"
CONNECTIONS_SCHEMA = "component1 string, port1 string, component2 string, port2 string"
CATALOGS_SCHEMA = "catalog_key string, catalog_id string, taxonomy_id string"
METRICS_SCHEMA = "catalog_key string, metric_id string, terms_operator string, time_operator string"
TERMS_SCHEMA = (
    "catalog_key string, metric_id string, term_ord int, taxonomy_category string, "
    "output_id string, location_ports array<string>"
)
REFERENCES_SCHEMA = "pos long, reference string"
