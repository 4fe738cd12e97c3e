"""Items of the arrays of one large JSON document, read in as many tasks as the file has splits.

The file is read as text whose records end at ``}``, wherever a split begins. What a record means depends on what came
before it: whether it begins within a string, how deep in objects, and in which item. All three are running
sums over the records in file order: each split is summed up on its own, the few totals (one row a split) are added up
on the driver, and every split starts from what the ones before it left. No task sees more than its split, and an
item that lies across splits is put together from its records.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from viewloom.staging import stage

#: Items are objects of an array of the root's object: ``{"root": {"array": [ITEM, ...]}}``.
ITEM_DEPTH = 3

# Between strings: what is neither a quote nor a brace. A string: its characters, escapes taken together.
_PLAIN, _STRING = r'[^"{]++', r'"(?:[^"\\]++|\\.)*+"'
_BEFORE = rf"(?:{_PLAIN}|{_STRING})*+"
# What is left of a string in which a record begins.
_REST = r'(?:[^"\\]++|\\.)*+"'


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _running(records: DataFrame, value: Column, name: str) -> DataFrame:
    """``records`` with the sum of ``value`` over all records before each, as ``name``; staged."""
    spark = records.sparkSession
    valued = records.withColumn("_value", value)
    totals = valued.groupBy("split").agg(F.sum("_value").alias("n")).orderBy("split").collect()  # a row a split
    before = accumulate((row["n"] for row in totals), initial=0)
    offsets = spark.createDataFrame([(row["split"], n) for row, n in zip(totals, before)], "split long, _offset long")
    earlier = Window.partitionBy("split").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = valued.withColumn("_within", F.coalesce(F.sum("_value").over(earlier), F.lit(0)))
    rows = rows.join(F.broadcast(offsets), "split").withColumn(name, F.col("_within") + F.col("_offset"))
    return stage(rows.drop("_value", "_within", "_offset"), name)


def _records(spark: SparkSession, path: str) -> DataFrame:
    """split (where it begins in the file), pos (grows with the place in the split) and text, without its ``}``."""
    lines = spark.read.option("lineSep", "}").text(path)
    records = lines.select(
        F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("pos"), F.col("value").alias("text")
    )
    return stage(records, "records")


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """(array, item): every object of an array of the root's object, as text, under the array's name.

    Objects at that depth which are no items of a named array have an empty name. Strings may hold braces, brackets and
    escaped quotes, and items may hold objects and arrays.
    """
    bare = F.regexp_replace("text", r"(?s)\\.", "")
    records = _running(_records(spark, path), _count(bare, '"'), "quotes")
    quoted = F.when(F.col("quotes") % 2 == 1, '"').otherwise("")  # a record that begins within a string
    outside = F.regexp_replace(F.concat(quoted, bare), r'(?s)"[^"]*("|$)', "")
    ends_outside = (F.col("quotes") + _count(bare, '"')) % 2 == 0
    records = records.withColumns(
        {"opened": _count(outside, "{"), "closed": F.when(ends_outside, 1).otherwise(0)}
    )
    records = _running(records, F.col("opened") - F.col("closed"), "depth")

    inner = F.col("depth") >= ITEM_DEPTH
    opening = ~inner & (F.col("depth") + F.col("opened") >= ITEM_DEPTH)
    after = F.col("depth") + F.col("opened") - F.col("closed")
    ending = (inner | opening) & (F.col("closed") == 1) & (after == ITEM_DEPTH - 1)
    records = records.filter(inner | opening).withColumn("ending", ending)
    records = _running(records, F.col("ending").cast("long"), "item")

    # What stands before the item's own brace tells its array: a comma alone, that of the item before it.
    skipped = ITEM_DEPTH - 1 - F.col("depth")
    head = F.lit(None).cast("string")
    for begun in (0, 1):
        for braces in range(ITEM_DEPTH):
            pattern = rf"(?s)^({_REST * begun}(?:{_BEFORE}\{{){{{braces}}}{_BEFORE})\{{"
            fits = (skipped == braces) & (F.col("quotes") % 2 == begun)
            head = F.when(fits, F.regexp_extract("text", pattern, 1)).otherwise(head)
    head = F.when(opening, head)
    named = F.regexp_extract(F.col("head"), r'(?s)"((?:[^"\\]|\\.)*)"\s*:\s*\[\s*$', 1)
    records = records.withColumn("head", head)
    continued = F.col("head").rlike(r"^\s*,\s*$")
    records = records.withColumns(
        {
            "named": F.when(F.col("head").isNotNull() & ~continued, named),
            "piece": F.concat(F.expr("substring(text, coalesce(length(head), 0) + 1)"), F.lit("}")),
        }
    )
    starts = records.filter("named IS NOT NULL").select("item", "named").orderBy("item").collect()  # a row a key of the root
    array = F.lit("")
    for row in starts:
        array = F.when(F.col("item") >= row["item"], row["named"]).otherwise(array)

    whole = F.col("head").isNotNull() & F.col("ending")
    lone = records.filter(whole).select("item", F.col("piece").alias("text"))
    parts = records.filter(~whole).groupBy("item").agg(F.sort_array(F.collect_list(F.struct("split", "pos", "piece"))).alias("parts"))
    joined = parts.select("item", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("text"))
    return lone.unionByName(joined).select(array.alias("array"), F.col("text").alias("item"))


def array_items(items: DataFrame, array: str, shape: str) -> DataFrame:
    """The items of one array as columns of ``shape``. A text that is no such object fails."""
    parsed = F.from_json("item", f"struct<{shape}>", {"mode": "FAILFAST"}).alias("_item")
    return items.filter(F.col("array") == array).select(parsed).select("_item.*")
