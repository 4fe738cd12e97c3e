"""Data checks. Each returns its violations as (rule, subject, detail) rows.

``assert_clean`` turns violations into an exception; its message shows the first ones and
how many there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.functions import or_empty
from viewloom.operators.references import malformed_references, unknown_catalogs
from viewloom.schemas import CALENDAR_COLUMNS, FILTERED_COLUMNS, OPERATORS, SIMULATION_COLUMNS

SHOWN = 20


def _violation(df: DataFrame, rule: str, subject: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), subject.alias("subject"), detail.alias("detail"))


def assert_clean(violations: DataFrame, error: type[Exception] = ValueError) -> None:
    shown = violations.limit(SHOWN + 1).collect()
    if shown:
        lines = [f"{v['rule']}: {v['subject']}: {v['detail']}" for v in shown[:SHOWN]]
        if len(shown) > SHOWN:
            lines.append(f"{violations.count()} violations in all; the checks return every one as a row")
        raise error("; ".join(lines))


# Tables against their column contracts.


def column_violations(
    spark: SparkSession, table: str, columns: Sequence[str], contract: Sequence[str], ordered: bool = False
) -> DataFrame:
    """What ``columns`` lack of ``contract`` or have beyond it; with ``ordered`` also another order."""
    found = [("column_missing", table, name) for name in contract if name not in columns]
    found += [("column_unknown", table, name) for name in columns if name not in contract]
    if ordered and not found and list(columns) != list(contract):
        found.append(("column_order", table, ", ".join(columns)))
    return spark.createDataFrame(found, "rule string, subject string, detail string")


def simulation_column_violations(df: DataFrame) -> DataFrame:
    return column_violations(df.sparkSession, "simulation", df.columns, SIMULATION_COLUMNS)


def filtered_column_violations(df: DataFrame) -> DataFrame:
    return column_violations(df.sparkSession, "filtered", df.columns, FILTERED_COLUMNS)


def calendar_column_violations(spark: SparkSession, columns: Sequence[str]) -> DataFrame:
    return column_violations(spark, "calendar", columns, CALENDAR_COLUMNS, ordered=True)


# Catalogs against the taxonomy.


def taxonomy_id_violations(catalogs: DataFrame, taxonomy_id: str) -> DataFrame:
    wrong = catalogs.filter(~F.col("taxonomy_id").eqNullSafe(F.lit(taxonomy_id)))
    return _violation(wrong, "taxonomy_id", F.col("catalog_key"), F.col("taxonomy_id"))


def category_violations(terms: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Terms whose category the taxonomy does not define."""
    known = taxonomy.select(F.col("category_id").alias("taxonomy_category")).distinct()
    return _violation(
        terms.join(known, "taxonomy_category", "left_anti"),
        "unknown_category",
        F.concat_ws(".", "catalog_key", "metric_id"),
        or_empty(F.col("taxonomy_category")),
    )


def port_violations(terms: DataFrame, taxonomy: DataFrame, ports: DataFrame) -> DataFrame:
    """Location ports that the term's category, a known one, does not define."""
    known = taxonomy.select(F.col("category_id").alias("taxonomy_category")).distinct()
    defined = ports.select(
        F.col("category_id").alias("taxonomy_category"), F.col("port_id").alias("port")
    ).distinct()
    used = terms.select("catalog_key", "metric_id", "taxonomy_category", F.explode("location_ports").alias("port"))
    return _violation(
        used.join(defined, ["taxonomy_category", "port"], "left_anti").join(known, "taxonomy_category", "left_semi"),
        "unknown_port",
        F.concat_ws(".", "catalog_key", "metric_id"),
        F.concat_ws(".", "taxonomy_category", "port"),
    )


def catalog_violations(
    catalogs: DataFrame, terms: DataFrame, taxonomy: DataFrame, ports: DataFrame, taxonomy_id: str
) -> DataFrame:
    """All catalogs at once, including metrics no view selects."""
    return (
        taxonomy_id_violations(catalogs, taxonomy_id)
        .unionByName(category_violations(terms, taxonomy))
        .unionByName(port_violations(terms, taxonomy, ports))
    )


def definition_violations(metrics: DataFrame, terms: DataFrame) -> DataFrame:
    """Metrics and terms that lack a required field or name an unknown operator."""
    subject = F.concat_ws(".", "catalog_key", "metric_id")
    wrong = [
        _violation(
            metrics.filter(~F.coalesce(F.col(name).isin(*OPERATORS), F.lit(False))),
            "unknown_operator",
            subject,
            F.concat_ws(" ", F.lit(name), F.col(name)),
        )
        for name in ("terms_operator", "time_operator")
    ]
    absent = [
        _violation(terms.filter(F.col(name).isNull()), "missing_field", subject, F.lit(name))
        for name in ("taxonomy_category", "output_id")
    ]
    named = metrics.filter(F.col("metric_id").isNotNull())
    without_terms = named.join(terms.select("catalog_key", "metric_id").distinct(), ["catalog_key", "metric_id"], "left_anti")
    absent.append(_violation(without_terms, "missing_field", subject, F.lit("terms")))
    unnamed = _violation(
        metrics.filter(F.col("metric_id").isNull()), "missing_field", F.col("catalog_key"), F.lit("metric_id")
    )
    return reduce(DataFrame.unionByName, [*wrong, *absent, unnamed])


# Models.


def model_violations(requested: DataFrame, models: DataFrame) -> DataFrame:
    """Requested model ids that the library lacks, or that have no category."""
    latest = models.groupBy("model_id").agg(
        F.max_by(F.struct("taxonomy_category"), "pos")["taxonomy_category"].alias("taxonomy_category"),
        F.lit(True).alias("known"),
    )
    found = requested.select("model_id").distinct().join(latest, "model_id", "left")
    problem = F.when(F.col("known").isNull(), "unknown model").when(
        F.col("taxonomy_category").isNull(), "model without category"
    )
    return _violation(found.filter(problem.isNotNull()), "model", F.col("model_id"), problem)


# References.


def reference_violations(references: DataFrame) -> DataFrame:
    return _violation(
        malformed_references(references),
        "reference_format",
        F.col("reference"),
        F.lit("expected format '<catalog_id>.<metric_id>'"),
    )


def catalog_reference_violations(references: DataFrame, catalogs: DataFrame) -> DataFrame:
    return _violation(
        unknown_catalogs(references, catalogs),
        "unknown_catalog",
        F.concat_ws(".", "catalog_key", "metric_id"),
        F.col("catalog_key"),
    )


def time_operator_violations(resolved: DataFrame) -> DataFrame:
    """Selected metrics that ask for a time operator other than the sum."""
    return _violation(
        resolved.filter(~F.coalesce(F.col("time_operator") == "sum", F.lit(False))),
        "time_operator",
        F.concat_ws(".", "catalog_key", "metric_id"),
        or_empty(F.col("time_operator")),
    )


def location_violations(structure: DataFrame) -> DataFrame:
    """Structure rows whose component cannot be located."""
    return _violation(
        structure.filter(F.col("location_problem").isNotNull()),
        "location",
        F.concat_ws(".", "catalog_key", "metric_id"),
        F.col("location_problem"),
    )
