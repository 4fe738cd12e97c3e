"""Joins of a large table with a lookup table of unknown size.

A lookup is broadcast only after its size has been measured against a budget. Beyond the budget both sides
are shuffled. Keys that hold more rows than one task should take are then split by adaptive execution, which
sees the sizes of the shuffled partitions: the large table is read once, and no key has to be counted before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW_OVERHEAD_BYTES = 48


@dataclass(frozen=True)
class Limits:
    """Sizes that decide how a join runs; they never decide what it returns."""

    broadcast_bytes: int = 64 * 1024 * 1024


DEFAULT_LIMITS = Limits()


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of one row: text lengths, 8 per other column, overhead."""
    fixed = ROW_OVERHEAD_BYTES + 8 * len(df.columns)
    size = F.lit(fixed).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, T.ArrayType):
            size = size + F.coalesce(F.octet_length(F.to_json(field.name)), F.lit(0))
    return size


def measured_bytes(df: DataFrame) -> int:
    """Estimated in-memory size of a lookup table (runs one small aggregation)."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()["b"]


def fits(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    return measured_bytes(df) <= limits.broadcast_bytes


def lookup_join(
    facts: DataFrame, lookup: DataFrame, on: Sequence[str], limits: Limits = DEFAULT_LIMITS, small: bool | None = None
) -> DataFrame:
    """Inner join of ``facts`` with ``lookup``: broadcast within the budget, else shuffled.

    ``small`` says whether the lookup fits, where that is known. The shuffled join asks for a sort-merge join, whose
    large partitions adaptive execution reads in several tasks, each with the few lookup rows of that partition.
    Copies of one row are split like any others, by the task that wrote them.
    """
    if fits(lookup, limits) if small is None else small:
        return facts.join(F.broadcast(lookup), list(on), "inner")
    return facts.dropna(subset=list(on)).join(lookup.hint("merge"), list(on), "inner")
