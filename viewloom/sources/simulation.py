"""Simulation table source."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.operators.checks import assert_clean, simulation_column_violations
from viewloom.schemas import SIMULATION_SCHEMA


def read_simulation(spark: SparkSession, path: str) -> DataFrame:
    """Parquet file, glob or directory (also one partitioned by block or output)."""
    suffix = PurePosixPath(path).suffix.lower()
    if suffix not in ("", ".parquet"):
        raise ValueError(f"Simulation table file '{path}' is not a parquet file")
    table = spark.read.parquet(path)
    assert_clean(simulation_column_violations(table))
    return table.select(
        *(
            F.col(f.name) if table.schema[f.name].dataType == f.dataType else F.col(f.name).cast(f.dataType)
            for f in SIMULATION_SCHEMA.fields
        )
    )
