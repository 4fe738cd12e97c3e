"""Calendar filter and calendar checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.operators.joins import DEFAULT_LIMITS, Limits, lookup_join, row_bytes


@dataclass(frozen=True)
class CalendarSummary:
    """What one aggregation over the calendar tells the planner."""

    first: int | None
    last: int | None
    low_block: object
    high_block: object
    size: int
    one_index_per_date: bool
    contiguous: bool

    @property
    def is_a_range(self) -> bool:
        """One block, and every index between the first and the last exactly once: then
        being in the calendar is a range test."""
        return self.contiguous and self.low_block == self.high_block


def summarise_calendar(calendar: DataFrame) -> CalendarSummary:
    row = calendar.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("absolute_time_index").alias("first"),
        F.max("absolute_time_index").alias("last"),
        F.min("block").alias("low_block"),
        F.max("block").alias("high_block"),
        F.count("block").alias("blocks"),
        F.countDistinct("absolute_time_index").alias("indexes"),
        F.countDistinct("granular_date").alias("dates"),
        F.coalesce(F.sum(row_bytes(calendar)), F.lit(0)).alias("size"),
    ).first()
    rows = row["rows"]
    complete = rows > 0 and row["blocks"] == row["indexes"] == rows and row["last"] - row["first"] == rows - 1
    return CalendarSummary(
        first=row["first"],
        last=row["last"],
        low_block=row["low_block"],
        high_block=row["high_block"],
        size=row["size"],
        one_index_per_date=rows == row["dates"],
        contiguous=complete,
    )


def constant_rows(simulation: DataFrame) -> DataFrame:
    """Rows that do not depend on time."""
    return simulation.filter(F.col("absolute_time_index").isNull())


def _equal(left: DataFrame, right: DataFrame, name: str, other: str) -> Column:
    """Equality that never casts text to a number: unequal types compare as text."""
    if left.schema[name].dataType == right.schema[other].dataType:
        return F.col(name) == F.col(other)
    return F.col(name).cast("string") == F.col(other).cast("string")


def filter_by_calendar(
    simulation: DataFrame,
    calendar: DataFrame,
    limits: Limits = DEFAULT_LIMITS,
    summary: CalendarSummary | None = None,
) -> DataFrame:
    """Rows whose (index, block) is in the calendar, with its date, plus all constant rows.

    Constant rows skip the block test and get a null date of the calendar's type. The
    calendar's index and block ranges become literal predicates, so the scan can skip row
    groups outside of them. A calendar within the broadcast budget is looked up in one
    pass over the table; beyond it the time-dependent rows take a split shuffle join.
    """
    summary = summary or summarise_calendar(calendar)
    index = F.col("absolute_time_index")
    in_range = F.lit(False) if summary.first is None else index.between(summary.first, summary.last)
    dates = calendar.select(
        F.col("absolute_time_index").alias("_index"),
        F.col("block").alias("_block"),
        "granular_date",
    )
    same_type = simulation.schema["block"].dataType == calendar.schema["block"].dataType
    if same_type and summary.low_block is not None:
        in_range = in_range & F.col("block").between(summary.low_block, summary.high_block)
    same_block = _equal(simulation, dates, "block", "_block")
    if summary.size <= limits.broadcast_bytes:
        # Joined on the integer alone, which hashes faster than with the block; no match
        # leaves the block comparison null.
        looked_up = simulation.filter(index.isNull() | in_range).join(
            F.broadcast(dates), index == F.col("_index"), "left"
        )
        if not (same_type and summary.is_a_range):
            looked_up = looked_up.filter(index.isNull() | same_block)
        return looked_up.select(*simulation.columns, "granular_date")
    by_index = dates.withColumnRenamed("_index", "absolute_time_index")
    timed = lookup_join(simulation.filter(in_range), by_index, ["absolute_time_index"], limits).filter(same_block)
    no_date = F.lit(None).cast(calendar.schema["granular_date"].dataType).alias("granular_date")
    return timed.select(*simulation.columns, "granular_date").unionByName(
        constant_rows(simulation).select("*", no_date)
    )


def rows_in_calendar(filtered: DataFrame, calendar: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Time-dependent rows whose (index, block) is in the calendar; all of them after the filter."""
    keys = calendar.select("absolute_time_index", F.col("block").alias("_block")).distinct()
    same_block = _equal(filtered, keys, "block", "_block")
    found = lookup_join(filtered, keys, ["absolute_time_index"], limits).filter(same_block)
    return found.select(*filtered.columns)


def date_steps(calendar: DataFrame) -> DataFrame:
    """Difference between the dates of each index and the one before it.

    Indexes are consecutive integers, so the previous row is found by an equi-join; an
    unpartitioned window would take the whole calendar through one task.
    """
    per_index = calendar.groupBy("absolute_time_index").agg(F.min("granular_date").alias("granular_date"))
    previous = per_index.select(
        (F.col("absolute_time_index") + 1).alias("absolute_time_index"),
        F.col("granular_date").alias("previous_date"),
    )
    return per_index.join(previous, "absolute_time_index").select(
        "absolute_time_index", (F.col("granular_date") - F.col("previous_date")).alias("step")
    )


def calendar_violations(calendar: DataFrame) -> DataFrame:
    """One row per broken rule: indexes must be 0..N-1, date steps must be constant.

    Rows of a distributed table have no order, so a complete calendar passes in any
    file order. Null indexes break the first rule.

    Where indexes are 0..N-1 and all dates are given, steps are constant if every date is the first one plus
    its index times the mean step: one more aggregation, in which nothing is shuffled by index. Else the
    steps that exist are found by a join.
    """
    index, date = F.col("absolute_time_index"), F.col("granular_date")
    # Dates stay in Spark: only microsecond counts reach the driver, as Python's dates end at year 9999.
    epoch = F.lit("1970-01-01").cast(calendar.schema["granular_date"].dataType)
    micros = F.timestamp_diff("MICROSECOND", epoch, date)
    known = calendar.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(date).alias("dates"),
        F.countDistinct(index).alias("indexes"),
        F.min(index).alias("first"),
        F.max(index).alias("last"),
        F.min_by(micros, index).alias("low"),
        F.max_by(micros, index).alias("high"),
    )
    known = known.withColumn("span", F.col("high") - F.col("low")).first()
    rows = known["rows"]
    contiguous = rows == 0 or (known["indexes"], known["first"], known["last"]) == (rows, 0, rows - 1)
    if not contiguous or known["dates"] < rows:
        # More than one distinct step shows as a smallest step unlike the largest.
        steps = date_steps(calendar).agg(F.min("step").alias("low"), F.max("step").alias("high"))
        even = steps.filter(F.col("low") != F.col("high")).isEmpty()
    elif rows < 3:
        even = True
    else:
        step, rest = divmod(known["span"], rows - 1)
        off = micros - F.lit(known["low"]) != index * F.lit(step)
        even = rest == 0 and calendar.filter(off).isEmpty()
    found = []
    if not contiguous:
        found.append(("calendar_index", "absolute_time_index", "indexes are not 0 to N-1, each once"))
    if not even:
        found.append(("calendar_step", "granular_date", "dates do not advance by one constant step"))
    return calendar.sparkSession.createDataFrame(found, "rule string, subject string, detail string")
