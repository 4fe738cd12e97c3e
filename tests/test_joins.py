import pytest
from pyspark.sql import functions as F

from viewloom import Limits
from viewloom.operators.joins import fits, lookup_join, measured_bytes


@pytest.fixture(scope="module")
def facts(spark):
    """Two thirds of the rows are copies of one row; some keys are null."""
    key = F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 5 != 0, F.concat(F.lit("k"), F.col("id") % 7))
    return spark.range(0, 3000, numPartitions=6).select(key.alias("k"), F.lit(1).alias("v"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("hot", "x"), ("hot", "y"), ("k1", "x"), ("k2", "z"), ("none", "z"), (None, "z")], "k string, w string")


@pytest.mark.parametrize("limits", [Limits(), Limits(0)])
def test_lookup_join_equals_a_plain_join(facts, lookup, limits):
    plain = facts.join(lookup, "k").groupBy("k", "v", "w").count()
    joined = lookup_join(facts, lookup, ["k"], limits)
    assert joined.columns == ["k", "v", "w"]
    assert sorted(joined.groupBy("k", "v", "w").count().collect()) == sorted(plain.collect())


def test_a_hot_key_is_split_without_a_count(spark, facts, lookup):
    """Two thirds of the rows have one key: its partition is read in several tasks, and the rows are read once."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        wide = facts.withColumn("text", F.sha2(F.concat("v", F.rand(1).cast("string")), 512))
        joined = lookup_join(wide, lookup, ["k"], Limits(0)).withColumn("task", F.spark_partition_id())
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        assert len({row["task"] for row in rows if row["k"] == "hot"}) > 1
        assert plan.split("== Initial Plan ==")[0].count("Range (0, 3000") == 1
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_measured_size_grows_with_text(spark):
    short = spark.createDataFrame([("a", 1)] * 10, "k string, v long")
    long = spark.createDataFrame([("a" * 1000, 1)] * 10, "k string, v long")
    assert measured_bytes(long) - measured_bytes(short) == 9990
    assert fits(short, Limits(broadcast_bytes=10_000)) and not fits(long, Limits(broadcast_bytes=10_000))
    assert measured_bytes(short.limit(0)) == 0
