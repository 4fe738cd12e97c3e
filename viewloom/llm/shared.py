"""Staged tables and joins whose smaller side is broadcast only after its size is known."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.staging import new_folder, remove

#: A side of a join is broadcast up to this many estimated bytes; beyond it both sides are shuffled.
BROADCAST_BYTES = 32 << 20


class Staging:
    """Tables of one operator call, written to the shared folder and read back.

    A lost executor takes none of them along. ``drop`` removes a table that nothing reads any
    more; those that a returned DataFrame still reads go when the driver's JVM ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = new_folder(spark, name)
        self.repeated = None

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        table.staged_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            remove(self.spark, table.staged_path)


def sized(df: DataFrame, row_bytes: Column | int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a staged table, marked for broadcast if its rows' bytes add up to ``limit`` at most.

    Beyond the limit it is marked for a join that shuffles both sides and splits skewed keys.
    """
    size = df.agg(F.sum(row_bytes if isinstance(row_bytes, Column) else F.lit(row_bytes))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df.hint("merge")


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Documents with ``doc`` (their id; the largest long if null) and ``key``, a hash of id and text.

    Rows that repeat id and text share both, and so share whatever is decided for them.
    """
    return docs.select(
        *columns,
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.xxhash64("doc_id", "text").alias("key"),
    )


def texts_of(docs: DataFrame, wanted: DataFrame, row_bytes: Column | int, staging: Staging) -> DataFrame:
    """``wanted``, a staged table, with the columns of its documents, found by ``doc`` and ``key``.

    Rows that repeat id and text give one row.
    """
    texts = docs.join(sized(wanted, row_bytes), ["doc", "key"])
    if staging.repeated is None:  # an operator call asks for texts of one documents table
        repeated = docs.groupBy("doc", "key").count().where("count > 1")
        staging.repeated = staging.write(repeated, "repeated")
        staging.repeats = not staging.repeated.isEmpty()
    repeated = staging.repeated
    if not staging.repeats:
        return texts
    again = repeated.select("doc", "key")
    once = texts.join(again, ["doc", "key"], "left_semi").dropDuplicates(["doc", "key"])
    return texts.join(sized(again, 48), ["doc", "key"], "left_anti").unionByName(once)
