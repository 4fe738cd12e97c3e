"""Metric structure: which output of which component feeds which metric, and where."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions import qualified_model
from viewloom.operators.locating import locate, location_port_names

METRIC_KEYS = ["catalog_key", "metric_id"]


def categorised_models(models: DataFrame) -> DataFrame:
    return models.filter((F.col("taxonomy_category").isNotNull()) & (F.col("taxonomy_category") != ""))


def models_by_category(models: DataFrame) -> DataFrame:
    """(taxonomy_category, model_id) index as rows; repeats of a model id are kept.

    Rows instead of one list per category: a category may hold any number of models.
    """
    return categorised_models(models).select("taxonomy_category", "model_id")


def models_in_category(models: DataFrame, category: str) -> DataFrame:
    return models_by_category(models).filter(F.col("taxonomy_category") == category).select("model_id")


def instantiated_components(components: DataFrame) -> DataFrame:
    """Components whose model reference is qualified by a library."""
    return components.filter(F.coalesce(F.col("model_ref").contains("."), F.lit(False)))


def components_by_model(components: DataFrame) -> DataFrame:
    """(model_ref, component) index as rows; copies are kept."""
    return instantiated_components(components).select("model_ref", "component")


def instances_of_model(components: DataFrame, model_ref: str) -> DataFrame:
    return components_by_model(components).filter(F.col("model_ref") == model_ref).select("component")


def model_terms(metrics: DataFrame, terms: DataFrame, models: DataFrame) -> DataFrame:
    """Terms of ``metrics`` with the qualified models of their category.

    Joins of metadata are left to adaptive execution: it knows the sizes when it gets there,
    broadcasts what is small and splits partitions that a hot category or catalog makes large.
    """
    categories = (
        categorised_models(models)
        .select("taxonomy_category", qualified_model(F.col("library_id"), F.col("model_id")).alias("model_ref"))
        .groupBy("taxonomy_category", "model_ref")
        .agg(F.count(F.lit(1)).alias("_models"))
    )
    return terms.join(metrics, METRIC_KEYS).join(categories, "taxonomy_category")


def metric_structure(
    metrics: DataFrame,
    terms: DataFrame,
    models: DataFrame,
    components: DataFrame,
    connections: DataFrame,
) -> DataFrame:
    """Structure of all ``metrics`` (distinct catalog_key, metric_id) at once.

    Further columns of ``metrics`` are kept. The structure is a bag; equal rows of a
    metric are one row with their number in ``copies``, so that they are joined with the
    fact table once. Rows that cannot be located have a null ``metric_location`` and a
    ``location_problem``.
    """
    instances = (
        instantiated_components(components)
        .groupBy("component", "model_ref")
        .agg(F.count(F.lit(1)).alias("_instances"))
    )
    rows = instances.join(model_terms(metrics, terms, models), "model_ref").withColumn(
        "_copies", F.col("_instances") * F.col("_models")
    )
    keys = [*metrics.columns, "term_ord", "model_ref", "component", "output_id", "_copies"]
    located = locate(rows.select(*keys, "location_ports"), keys, connections, location_port_names(terms))
    merged = located.groupBy(
        *metrics.columns, "component", "metric_location", F.col("output_id").alias("output")
    ).agg(F.sum("_copies").alias("copies"), F.min("location_problem").alias("location_problem"))
    return merged.select(
        *metrics.columns,
        "component",
        "metric_location",
        F.lit("").alias("breakdown_properties"),
        "output",
        F.lit("1").alias("weight_output_id"),
        "copies",
        "location_problem",
    )
