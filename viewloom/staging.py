"""Tables written once and read back, to cut lineage between stages.

Staged tables live in the shared folder named by ``spark.checkpoint.dir``, so a lost
executor never takes one with it, and every later use reads columnar files. ``released``
removes what was staged within it; the rest goes when the driver's JVM ends.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Fixed value: rows of a row group of every written table.
ROW_GROUP_OPTION, ROW_GROUP_ROWS = "parquet.block.row.count.limit", 64_000

#: The folders staged within the innermost ``released`` of this thread.
_scope: ContextVar[list[str] | None] = ContextVar("viewloom_staged", default=None)


def staging_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a local session without it uses its warehouse, a cluster is refused."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/staging"


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the staging root that is removed when the driver's JVM ends."""
    path = f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"
    files, where = file_system(spark, path)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def remove(spark: SparkSession, path: str) -> None:
    files, where = file_system(spark, path)
    files.delete(where, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the staging root and return a reader of what was written."""
    spark = df.sparkSession
    folder = new_folder(spark, f"viewloom-{name}")
    staged = _scope.get()
    if staged is not None:
        staged.append(folder)
    path = f"{folder}/{name}"
    df.write.option("compression", "zstd").option(ROW_GROUP_OPTION, ROW_GROUP_ROWS).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``stage``, and aggregates over what is written, taken by the write itself.

    A task that runs twice may be counted twice, so that sums are upper bounds: they serve to compare a size
    with a budget, or a number with zero.
    """
    observation = Observation()
    observed = df.observe(observation, *[measure.alias(key) for key, measure in measures.items()])
    return stage(observed, name), observation.get


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that this thread stages within; nothing that reads them may be used afterwards."""
    token = _scope.set([])
    try:
        yield
    finally:
        for folder in _scope.get():
            remove(spark, folder)
        _scope.reset(token)
