"""Metric references of a view, and the definitions they point to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.functions import is_wellformed_reference, reference_catalog, reference_metric
from viewloom.schemas import OPERATORS


def parse_references(references: DataFrame) -> DataFrame:
    """Well-formed references as (pos, catalog_key, metric_id)."""
    return references.filter(is_wellformed_reference(F.col("reference"))).select(
        "pos",
        reference_catalog(F.col("reference")).alias("catalog_key"),
        reference_metric(F.col("reference")).alias("metric_id"),
    )


def metric_references(references: DataFrame) -> DataFrame:
    """Well-formed references as (catalog_pos, pos, catalog_key, metric_id).

    The view lists metrics by catalog, catalogs by first mention: order by
    (catalog_pos, pos). The pair replaces a global row number, which would need every
    reference in one task.
    """
    parsed = parse_references(references)
    first_mention = parsed.groupBy("catalog_key").agg(F.min("pos").alias("catalog_pos"))
    return parsed.join(first_mention, "catalog_key").select("catalog_pos", "pos", "catalog_key", "metric_id")


def malformed_references(references: DataFrame) -> DataFrame:
    return references.filter(~F.coalesce(is_wellformed_reference(F.col("reference")), F.lit(False)))


def latest_definitions(definitions: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last definition per key. Only the winner of each task is shuffled, whatever the repeats."""
    rest = [c for c in definitions.columns if c not in keys]
    winner = F.max_by(F.struct(*rest), F.col(order)).alias("_last")
    return definitions.groupBy(*keys).agg(winner).select(*keys, "_last.*")


def resolve_references(references: DataFrame, metrics: DataFrame) -> DataFrame:
    """References (catalog_key, metric_id) with the operators of their metric."""
    return references.join(metrics, ["catalog_key", "metric_id"], "inner")


def judged_references(references: DataFrame, catalogs: DataFrame, metrics: DataFrame) -> DataFrame:
    """Every reference with its metric's operators and a ``problem``, null where it can be built.

    Distinct references are judged once: a catalog or metric that many references name is one row
    of the lookups, and references that name nothing take no part in them.
    """
    columns = ["pos", "reference", "catalog_key", "metric_id", "terms_operator", "time_operator", "problem"]
    wellformed = is_wellformed_reference(F.col("reference"))
    named = references.filter(wellformed).select(
        "pos",
        "reference",
        reference_catalog(F.col("reference")).alias("catalog_key"),
        reference_metric(F.col("reference")).alias("metric_id"),
    )
    keys = ["catalog_key", "metric_id"]
    known_catalogs = catalogs.select("catalog_key", F.lit(True).alias("_catalog")).distinct()
    known = named.select(*keys).distinct().join(known_catalogs, "catalog_key", "left")
    known = known.join(metrics.select(*keys, "terms_operator", "time_operator", F.lit(True).alias("_metric")), keys, "left")
    problem = (
        F.when(F.col("_catalog").isNull(), "unknown_catalog")
        .when(F.col("_metric").isNull(), "unknown_metric")
        .when(~F.coalesce(F.col("terms_operator").isin(*OPERATORS), F.lit(False)), "terms_operator")
        .when(~F.coalesce(F.col("time_operator") == "sum", F.lit(False)), "time_operator")
    )
    known = known.select(*keys, "terms_operator", "time_operator", problem.alias("problem"))
    malformed = malformed_references(references).select(
        "pos", "reference", *[F.lit(None).cast("string").alias(c) for c in columns[2:6]], F.lit("reference_format").alias("problem")
    )
    return named.join(known, keys).select(*columns).unionByName(malformed)


def skipped_references(references: DataFrame, catalogs: DataFrame, metrics: DataFrame) -> DataFrame:
    """(pos, reference) of every reference to a metric that its catalog does not define; a view has none of them."""
    judged = judged_references(references, catalogs, metrics)
    return judged.filter(F.col("problem") == "unknown_metric").select("pos", "reference")


def unknown_catalogs(references: DataFrame, catalogs: DataFrame) -> DataFrame:
    return references.join(catalogs, "catalog_key", "left_anti")


def unknown_metrics(references: DataFrame, metrics: DataFrame) -> DataFrame:
    """References to a metric its catalog does not define; the view skips them."""
    return references.join(metrics, ["catalog_key", "metric_id"], "left_anti")


def get_metric(metrics: DataFrame, catalog_key: str, metric_id: str) -> DataFrame:
    """One metric of one catalog; raises if the catalog does not define it."""
    found = metrics.filter((F.col("catalog_key") == catalog_key) & (F.col("metric_id") == metric_id))
    if found.isEmpty():
        raise ValueError(f"Catalog {catalog_key} does not define metric {metric_id}")
    return found
