"""Calendar source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from viewloom.operators.checks import assert_clean, calendar_column_violations
from viewloom.schemas import CALENDAR_SCHEMA


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header. The header is read as data first, so extra columns are seen."""
    header = spark.read.option("header", False).csv(path).first()
    assert_clean(calendar_column_violations(spark, [] if header is None else [str(name) for name in header]))
    return (
        spark.read.schema(CALENDAR_SCHEMA).option("header", True).option("enforceSchema", False).option(
            "mode", "FAILFAST"
        )
    ).csv(path)
