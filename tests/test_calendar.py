from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from viewloom import Limits, calendar_violations, filter_by_calendar, read_calendar, rows_in_calendar
from viewloom import schemas as S
from viewloom.operators.calendar import constant_rows, date_steps, summarise_calendar
from viewloom.operators.checks import calendar_column_violations

START = datetime(2025, 1, 1)
SPLIT = Limits(broadcast_bytes=0)


def calendar(spark, rows):
    return spark.createDataFrame(rows, S.CALENDAR_SCHEMA)


def hourly(spark, n, block="1"):
    return calendar(spark, [(i, block, START + timedelta(hours=i)) for i in range(n)])


def rules(df):
    return sorted(r["rule"] for r in calendar_violations(df).collect())


@pytest.mark.parametrize("limits", [Limits(), SPLIT])
def test_filter_keeps_calendar_rows_and_constants(two_bus, limits):
    filtered = filter_by_calendar(two_bus.simulation, two_bus.calendar, limits)
    assert filtered.columns == list(S.FILTERED_COLUMNS)
    assert filtered.count() == 121
    timed = filtered.filter(F.col("absolute_time_index").isNotNull())
    assert rows_in_calendar(filtered, two_bus.calendar).count() == timed.count() == 120
    expected = START + F.make_dt_interval(hours=F.col("absolute_time_index").cast("int"))
    assert timed.filter(F.col("granular_date") != expected.cast("timestamp_ntz")).isEmpty()


@pytest.mark.parametrize("limits", [Limits(), SPLIT])
def test_block_mismatch_drops_timed_rows_only(two_bus, limits):
    other = two_bus.simulation.withColumn("block", F.lit("2"))
    filtered = filter_by_calendar(other, two_bus.calendar, limits)
    rows = filtered.collect()
    assert [(r["component"], r["granular_date"]) for r in rows] == [("load_AL", None)]


def test_numeric_and_text_blocks_compare_as_text(two_bus):
    numeric = two_bus.simulation.withColumn("block", F.col("block").cast("int"))
    assert filter_by_calendar(numeric, two_bus.calendar).count() == 121
    text = two_bus.simulation.withColumn("block", F.lit("B1"))
    integer_calendar = two_bus.calendar.withColumn("block", F.col("block").cast("int"))
    assert filter_by_calendar(text, integer_calendar).count() == 1


@pytest.mark.parametrize("limits", [Limits(), SPLIT])
def test_empty_calendar_keeps_constants(spark, two_bus, limits):
    assert filter_by_calendar(two_bus.simulation, calendar(spark, []), limits).count() == 1


def test_null_date_has_the_calendar_type(two_bus):
    text_dates = two_bus.calendar.withColumn("granular_date", F.col("granular_date").cast("string"))
    for limits in (Limits(), SPLIT):
        filtered = filter_by_calendar(two_bus.simulation, text_dates, limits)
        assert filtered.schema["granular_date"].dataType.simpleString() == "string"


def test_constant_rows(two_bus):
    assert [r["component"] for r in constant_rows(two_bus.simulation).collect()] == ["load_AL"]


def test_index_range_and_null_test_reach_the_scan(spark, two_bus_dir, two_bus):
    from tests.plans import formatted

    plan = formatted(filter_by_calendar(two_bus.simulation, two_bus.calendar))
    assert "PushedFilters: [Or(IsNull(absolute_time_index),And(And(GreaterThanOrEqual(absolute_time_index,0)" in plan
    assert "GreaterThanOrEqual(block,1),LessThanOrEqual(block,1)" in plan
    assert plan.count("Scan parquet") == 2 and "BroadcastHashJoin LeftOuter" in plan  # one scan, named twice


def test_summary(spark):
    summary = summarise_calendar(hourly(spark, 5))
    assert (summary.first, summary.last, summary.one_index_per_date) == (0, 4, True)
    assert summary.is_a_range
    assert not summarise_calendar(hourly(spark, 5).filter("absolute_time_index <> 2")).is_a_range
    assert not summarise_calendar(hourly(spark, 5).union(hourly(spark, 5, "2").offset(4))).is_a_range
    assert not summarise_calendar(hourly(spark, 0)).is_a_range
    same_date = calendar(spark, [(i, "1", START) for i in range(3)])
    assert not summarise_calendar(same_date).one_index_per_date


def test_sound_calendars_pass(spark):
    for n in (0, 1, 2, 30):
        assert rules(hourly(spark, n)) == []
    assert rules(calendar(spark, [(i, "1", START) for i in range(3)])) == []


def test_shuffled_calendar_passes(spark):
    assert rules(hourly(spark, 30).orderBy(F.desc("absolute_time_index"))) == []


def test_faulty_indexes(spark):
    for indexes in ([0, 2, 3], [1, 2, 3], [0, 1, 1], [0, None, 2]):
        rows = [(i, "1", START) for i in indexes]
        assert rules(calendar(spark, rows)) == ["calendar_index"], indexes


def test_uneven_steps(spark):
    rows = [(0, "1", START), (1, "1", START + timedelta(hours=1)), (2, "1", START + timedelta(hours=3))]
    assert rules(calendar(spark, rows)) == ["calendar_step"]


def test_date_steps(spark):
    steps = date_steps(hourly(spark, 4)).collect()
    assert sorted(r["absolute_time_index"] for r in steps) == [1, 2, 3]
    assert {r["step"] for r in steps} == {timedelta(hours=1)}


def test_column_names_and_order(spark):
    rules = lambda *names: [tuple(r)[::2] for r in calendar_column_violations(spark, names).collect()]
    assert rules("absolute_time_index", "block", "granular_date") == []
    assert rules("absolute_time_index", "granular_date") == [("column_missing", "block")]
    assert rules("absolute_time_index", "block", "granular_date", "more") == [("column_unknown", "more")]
    assert rules("block", "absolute_time_index", "granular_date") == [
        ("column_order", "block, absolute_time_index, granular_date")
    ]


def test_read_calendar(spark, tmp_path, two_bus_dir):
    read = read_calendar(spark, str(two_bus_dir / "calendar_file.csv"))
    assert read.count() == 25
    assert read.schema == S.CALENDAR_SCHEMA
    bad = tmp_path / "bad.csv"
    bad.write_text("absolute_time_index,block,granular_date,more\n0,1,2025-01-01 00:00:00,x\n")
    with pytest.raises(ValueError, match="column_unknown: calendar: more"):
        read_calendar(spark, str(bad))
    empty = tmp_path / "empty.csv"
    empty.write_text("absolute_time_index,block,granular_date\n")
    assert read_calendar(spark, str(empty)).isEmpty()
    days = tmp_path / "days.csv"
    days.write_text("absolute_time_index,block,granular_date\n0,B1,2025-01-01\n")
    assert tuple(read_calendar(spark, str(days)).first()) == (0, "B1", START)


def test_dates_past_year_9999_are_checked(spark):
    # Daily dates from 1995 reach beyond Python's last year; the check must not bring them to the driver.
    def daily(keys):
        return keys.select(
            F.col("id").alias("absolute_time_index"),
            F.lit("1").alias("block"),
            F.expr("cast(date_add(date'1995-01-01', cast(id as int)) as timestamp_ntz)").alias("granular_date"),
        )

    gapped = daily(spark.range(5_999_990, 6_000_010).filter("id % 1000 <> 7"))
    assert rules(gapped) == ["calendar_index"]
    whole = daily(spark.range(0, 6_000_000, 1, 4))
    assert rules(whole) == []
    uneven = whole.withColumn(
        "granular_date", F.expr("granular_date - make_dt_interval(0, 0, 0, cast(absolute_time_index % 7 = 3 as int))")
    )
    assert rules(uneven) == ["calendar_step"]
