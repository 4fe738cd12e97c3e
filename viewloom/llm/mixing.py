"""Mixing sources to target weights by entropy balancing over tokens.

Rates that keep the corpus's tokens as close as they can to how they are (in relative entropy, a
document weighing its words times its prior) while each source's tokens meet its target, and no document
is taken more than ``most`` times, are exponential tilts up to that limit: ``rate = min(most, prior *
exp(tilt of the source))``. The tilts solve a convex dual with one variable a source. Its gradient (words
taken at these rates, less the target) and its Hessian, which is diagonal (words of the documents
below the limit), are sums over all documents, so each Newton step is one aggregation over them, for all
sources at once. A step that leaves the interval in which a source's tilt must lie is replaced by its
middle. Sums are decimal, so that they do not depend on the order of rows.

Rates are then rounded to copies: within bounded parts of a source, largest documents first, each takes as
many copies as fit into the words owed so far (rate x words, less what was taken), or one more if the
smaller documents could not take what is left. What the parts of a source leave over or took too much, one
number a part, is passed on to other parts, which are rounded again, so what remains is about the size of
one of the smallest documents of these.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging, sized, texts_of

NEWTON_STEPS = 64
#: A tilt is done when its source's words are this near to the target, relatively.
NEAR = 1e-10
#: Documents of a source that are rounded together; a larger source has more parts.
PART_ROWS = 500
#: Share of a part's room that is used to take what other parts leave over, unless more is needed.
PASSED_ON = 0.1
WORD = r"[^\x20\x09-\x0D]+"


def _exact(words: Column) -> Column:
    """Fractions of words as decimals, whose sum is the same in any order."""
    return words.cast("decimal(38,18)")


def _rate(most: float) -> Column:
    return F.least(F.lit(float(most)), F.col("prior") * F.exp("tilt"))


def _ranked(sources: DataFrame, staging: Staging) -> DataFrame:
    """``sources`` with ``place``, from 0, by code point and null last, without one task for all."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = max(1, sources.rdd.getNumPartitions())
    parts = sources.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id())
    parts = staging.write(parts, "parts")
    within = Window.partitionBy("part").orderBy(*order)
    sizes, before, offsets = {r["part"]: r["count"] for r in parts.groupBy("part").count().collect()}, 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    offsets = sources.sparkSession.createDataFrame(offsets, "part int, before long")
    placed = parts.withColumn("n_before", F.row_number().over(within)).join(F.broadcast(offsets), "part")
    return placed.withColumn("place", F.col("before") + F.col("n_before") - 1).drop("part", "before", "n_before")


def source_targets(
    sizes: DataFrame, staging: Staging, weights: Sequence[float] = (1, 2, 3), most: float = 3, share: float = 1.0
) -> DataFrame:
    """source, source_size, n_docs, target, tilt: each source's target tokens and the tilt that meets it.

    ``sizes`` has source and size, and prior unless that is 1 for all documents.
    Sources in order weigh ``weights``, repeating, and share ``share`` of all sizes; no target exceeds
    ``most`` times its source (its documents with a prior above 0), and what is above goes to the others by weight.
    """
    if "prior" not in sizes.columns:
        sizes = sizes.withColumn("prior", F.lit(1.0))
    sources = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"),
        F.count("*").alias("n_docs"),
        F.coalesce(F.sum(F.when(F.col("prior") > 0, F.col("size"))), F.lit(0)).alias("reach"),
        F.sum(_exact(F.col("size") * F.col("prior"))).alias("base"),
        F.min(F.when(F.col("prior") > 0, F.col("prior"))).alias("least"),
    )
    sources = _ranked(staging.write(sources, "sources"), staging)
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("place", F.lit(len(weights))))
    sources = staging.write(sources.withColumn("weight", weight), "weighted")
    limit = most * F.col("reach")
    total, level = None, 0.0
    while True:  # each round caps more sources, so there are as many rounds as sources at most; in practice a few
        free = limit > level * F.col("weight")
        row = sources.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(~free, limit)).alias("capped"),
            F.sum(F.when(free, F.col("weight"))).alias("weight"),
        ).first()
        total = share * (row["total"] or 0)
        if not row["weight"] or (raised := (total - (row["capped"] or 0)) / row["weight"]) <= level:
            break
        level = raised
    target = F.least(limit, level * F.col("weight")).cast("double")
    sources = staging.write(sources.withColumn("target", target), "balanced")
    tilts = _tilts(sizes, sources, staging, most).select(F.col("source").alias("of"), "tilt")
    sources = sources.join(sized(tilts, 128), F.col("source").eqNullSafe(F.col("of")), "left")
    return sources.drop("of", "place", "weight", "reach", "base", "least")


def _tilts(sizes: DataFrame, sources: DataFrame, staging: Staging, most: float) -> DataFrame:
    """source, tilt of the sources with a target above 0: Newton on the dual, each step a pass over ``sizes``."""
    infinite = F.lit(float("inf"))
    now = sources.where("target > 0").select(
        "source",
        "target",
        F.ln(F.col("source_size") / F.col("base").cast("double")).alias("tilt"),
        F.ln(most / F.col("least")).alias("top"),  # from here on all documents are at the limit
        (-infinite).alias("low"),
        infinite.alias("high"),
        F.lit(False).alias("near"),
    )
    now = staging.write(now, "tilts")
    docs = sizes.select(F.col("source").alias("of"), "size", "prior").where("size > 0 AND prior > 0")
    for _ in range(NEWTON_STEPS):
        rows = docs.join(sized(now, 128), F.col("of").eqNullSafe(F.col("source")))
        taken = _exact(F.col("size") * F.col("rate"))
        sums = rows.withColumn("rate", _rate(most)).groupBy(*now.columns).agg(
            F.sum(taken).cast("double").alias("words"),
            F.coalesce(F.sum(F.when(F.col("rate") < most, taken)).cast("double"), F.lit(0.0)).alias("slope"),
        )
        missing = F.col("target") - F.col("words")
        step = F.when(F.col("slope") > 0, missing / F.col("slope")).otherwise(F.signum(missing))
        step = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), step))
        sums = sums.withColumn("low", F.when(missing > 0, F.col("tilt")).otherwise(F.col("low")))
        sums = sums.withColumn("high", F.when(missing < 0, F.col("tilt")).otherwise(F.col("high")))
        narrow = F.col("high") - F.col("low") < 1e-13
        near = F.col("near") | (F.abs(missing) <= NEAR * F.col("target")) | narrow | (F.abs(step) < 1e-15)
        onward = F.least(F.col("top"), F.col("tilt") + step)
        outside = (onward <= F.col("low")) | (onward >= F.col("high"))
        onward = F.when(outside, (F.col("low") + F.col("high")) / 2).otherwise(onward)
        moved = F.when(near, F.col("tilt")).otherwise(onward)
        sums = sums.select("source", "target", moved.alias("tilt"), "top", "low", "high", near.alias("near"))
        now = staging.write(sums, "tilts")
        if now.where("not near").isEmpty():
            break
    return now


def round_to_copies(sizes: np.ndarray, rate: float | np.ndarray, most: int) -> np.ndarray:
    """Copies of each document, sizes descending, whose words follow ``rate`` times the words so far.

    ``rate`` is one number or one for each document. Copies follow from below, but where the smaller documents
    could not take what is left over and can balance, or balance better, one copy more.
    """
    rates = np.broadcast_to(np.asarray(rate, np.float64), len(sizes))
    due = rates * sizes
    # what the smaller documents are due, and could take beyond that
    after = [np.append(x[::-1].cumsum()[::-1][1:], 0.0).tolist() for x in (due, most * sizes - due)]
    copies, owed = np.zeros(len(sizes), np.int64), 0.0
    for i, (size, own, smaller, spare) in enumerate(zip(sizes.tolist(), due.tolist(), *after)):
        owed += own
        if own > 0:
            fewer = min(most, max(0, int(owed / size)))
            unmet = owed - fewer * size - spare
            excess = (fewer + 1) * size - owed - smaller
            copies[i] = fewer + (fewer < most and unmet > 0 and max(0.0, excess) < unmet)
            owed -= copies[i] * size
    return copies


def _passed_on(rounded: DataFrame, staging: Staging, most: int) -> DataFrame:
    """of, of_part, largest, again: the parts that take what all parts left over.

    Their documents of ``largest`` words at most, as many as are left over, are rounded again at ``again`` on the mean.
    """
    sums = rounded.groupBy(F.col("source").alias("of")).agg(
        (F.sum(_exact(F.col("rate") * F.col("size"))).cast("double") - F.sum("taken")).alias("left")
    )
    sums = staging.write(sums.where(F.abs("left") >= 1), "left")
    small = rounded.join(sized(sums, 128), F.col("source").eqNullSafe(F.col("of")))
    small = small.where((F.col("size") > 0) & (F.col("rate") > 0) & (F.col("size") <= F.abs("left")))
    parts = small.groupBy("of", "part", "left").agg(F.sum("size").alias("words"), F.sum("taken").alias("taken"))
    up = F.col("left") > 0
    room = F.when(up, most * F.col("words") - F.col("taken")).otherwise(F.col("taken"))
    parts = staging.write(parts.withColumn("room", room), "parts")
    rooms = staging.write(parts.groupBy(F.col("of").alias("in")).agg(F.sum("room").alias("all_room")), "rooms")
    parts = parts.join(sized(rooms, 128), F.col("of").eqNullSafe(F.col("in"))).where("all_room > 0")
    used = F.greatest(F.lit(PASSED_ON), F.least(F.lit(1.0), F.abs("left") / F.col("all_room")))
    order = Window.partitionBy("of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("room").over(order), F.lit(0)) * F.col("used")
    parts = parts.withColumn("used", used).withColumn("before", before)
    share = F.least(F.col("room") * F.col("used"), F.abs("left") - F.col("before"))
    parts = parts.withColumn("share", share).where("share > 0")
    again = (F.col("taken") + F.when(up, F.col("share")).otherwise(-F.col("share"))) / F.col("words")
    return parts.select("of", F.col("part").alias("of_part"), F.abs("left").alias("largest"), again.alias("again"))


def mix_sources(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3, share: float = 1.0, prior: str | None = None
) -> DataFrame:
    """doc_id, source, size, source_size, target (of its source), copies and taken (copies x size).

    A size is the number of runs of characters other than space and ``\\t`` to ``\\r``; null and empty texts
    have none and are taken 0 times. No document is taken more than ``most`` times. ``prior`` names a column with
    the rate of a document, relative to others of its source, before the tilt; null is 1, and a document with
    0, less, NaN or infinity is not taken. Without it all documents of a source have one rate.

    One row per row of ``docs`` (doc_id, text, source; other columns are ignored, except that the
    result has ``doc`` and ``key`` to find a row again). A null source is a source, the last one. Null and
    repeated ids are allowed; repeated rows are rounded one by one. An empty table gives an empty
    result. Results do not depend on how rows are partitioned.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "mixing")
    weight = F.coalesce(F.col(prior).cast("double"), F.lit(1.0)) if prior else F.lit(1.0)
    sizes = docs.select(
        "doc_id",
        "source",
        F.when((weight > 0) & (weight < float("inf")), weight).otherwise(0.0).alias("prior"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        F.xxhash64("doc_id", "text", "source").alias("key"),
    )
    sizes = staging.write(sizes.withColumn("doc_id", F.col("doc_id").cast("long")), "sizes")
    targets = staging.write(source_targets(sizes, staging, weights, most, share), "targets")
    # a null source joins like any other
    targets = targets.withColumnRenamed("source", "of")
    rows = sizes.join(sized(targets, 128), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    parts = F.ceil(F.col("n_docs") / PART_ROWS)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("doc", "key"), parts))
    rows = rows.withColumn("rate", F.coalesce(_rate(most), F.lit(0.0)))

    def rounded(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "doc", "key"], ascending=[False, True, True], kind="stable")
        copies = round_to_copies(part["size"].to_numpy(), part["rate"].to_numpy(), most)
        return part.assign(copies=copies, taken=copies * part["size"].to_numpy())

    def rounded_again(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "doc", "key"], ascending=[False, True, True], kind="stable")
        sizes, copies = part["size"].to_numpy(), part["copies"].to_numpy().copy()
        rates = part["rate"].to_numpy()
        small = (sizes > 0) & (rates > 0) & (sizes <= part["largest"].iloc[0])
        mean = (rates[small] * sizes[small]).sum() / sizes[small].sum()
        rates = np.minimum(most, rates[small] * (float(part["again"].iloc[0]) / mean))
        copies[small] = round_to_copies(sizes[small], rates, most)
        return part.assign(copies=copies, taken=copies * sizes).drop(columns=["largest", "again"])

    schema = (
        "doc_id long, source string, size long, doc long, key long, source_size long, target double, part long,"
        " rate double, copies long, taken long"
    )
    rows = rows.select("doc_id", "source", "size", "doc", "key", "source_size", "target", "part", "rate")
    first = staging.write(rows.groupBy("source", "part").applyInPandas(rounded, schema), "rounded")
    again = sized(staging.write(_passed_on(first, staging, most), "again"), 128)
    same = F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part"))
    second = first.join(again, same).drop("of", "of_part").groupBy("source", "part").applyInPandas(rounded_again, schema)
    return first.join(again, same, "left_anti").unionByName(second).drop("part")


def mixed_documents(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), most: int = 3, prior: str | None = None
) -> DataFrame:
    """The documents that the mix takes, with all their columns and ``copies``; repeated rows are one row."""
    spark = docs.sparkSession
    staging = Staging(spark, "mixed")
    taken = mix_sources(docs, weights, most, prior=prior).where("copies > 0")
    taken = staging.write(taken.groupBy("doc", "key").agg(F.sum("copies").alias("copies")), "taken")
    keys = {
        "doc": F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)),
        "key": F.xxhash64("doc_id", "text", "source"),
    }
    found = texts_of(docs.withColumns(keys), taken, 64, staging)
    return found.select(*docs.columns, "copies")
