"""Terms aggregation and time aggregation.

Both work on structure rows (links) identified by ``_link``, whose metric and location are named by one group
column. The readable form groups by the metric's own columns; the view plan groups by a 64-bit fingerprint.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.functions import terms_value, zero_sum
from viewloom.operators.joins import DEFAULT_LIMITS, Limits, lookup_join, row_bytes
from viewloom.schemas import GRANULAR_COLUMNS, VIEW_COLUMNS
from viewloom.staging import stage, stage_measured

SERIES = ["component", "output"]
METRIC_GROUP = ["catalog_key", "metric_id", "metric_location", "breakdown_properties"]

#: Links of a group that one mask tells apart, and masks of a group at most.
MASK_LINKS, MASKS = 64, 4


@dataclass(frozen=True)
class Links:
    """Structure rows as the facts meet them.

    ``rows`` has component, output, the ``keys`` of its group, is_avg, copies and _link. Groups of up to
    ``MASK_LINKS * MASKS`` links are narrow: each of their links has a bit of its own (``_bit``) in a mask of the group
    (``_mask``, below ``masks``); both are null in wide groups.
    """

    rows: DataFrame
    keys: list[str]
    masks: int
    wide: bool
    small: bool | None = None


def group_table(links: DataFrame, group: str, labels: Sequence[str]) -> tuple[DataFrame, dict]:
    """Staged: ``group``, its ``labels`` and its number of links; with their bytes, the largest group's number of
    links, how many groups are wide, and how many share the name of another (``clashes``)."""
    named = F.struct(*labels)
    groups = links.groupBy(group).agg(
        F.min(named).alias("_first"), F.max(named).alias("_last"), F.count(F.lit(1)).alias("_links")
    )
    rows = groups.select(group, "_first.*", "_links", (~F.col("_first").eqNullSafe(F.col("_last"))).alias("_clash"))
    staged, measured = stage_measured(
        rows,
        "groups",
        bytes=F.coalesce(F.sum(row_bytes(rows.select(group, *labels))), F.lit(0)),
        clashes=F.count_if("_clash"),
        largest=F.coalesce(F.max("_links"), F.lit(0)),
        wide=F.count_if(F.col("_links") > MASK_LINKS * MASKS),
    )
    return staged.drop("_clash"), measured


def masked_links(links: DataFrame, group: str, groups: DataFrame, measured: dict, small: bool | None = None) -> Links:
    """Numbers the links of every narrow group; a wide one is never gathered."""
    narrow, rest, wide = links, None, measured["wide"] > 0
    if wide:
        sizes = groups.select(group, (F.col("_links") <= MASK_LINKS * MASKS).alias("_narrow"))
        split = links.join(sizes, group)
        narrow, rest = split.filter("_narrow").drop("_narrow"), split.filter("NOT _narrow").drop("_narrow")
    nth = F.row_number().over(Window.partitionBy(group).orderBy("_link")) - 1
    rows = narrow.withColumn("_nth", nth).withColumns(
        {
            "_mask": F.floor(F.col("_nth") / MASK_LINKS).cast("int"),
            "_bit": F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_nth") % MASK_LINKS),
        }
    )
    rows = rows.drop("_nth")
    if wide:
        nothing = {"_mask": F.lit(None).cast("int"), "_bit": F.lit(None).cast("long")}
        rows = rows.unionByName(rest.withColumns(nothing))
    masks = -(-min(measured["largest"], MASK_LINKS * MASKS) // MASK_LINKS)
    return Links(rows, [group], max(masks, 1), wide, small)


def unmasked_links(links: DataFrame, keys: Sequence[str], small: bool | None = None) -> Links:
    """All groups as wide ones, for keys of any number and kind."""
    nothing = {"_mask": F.lit(None).cast("int"), "_bit": F.lit(None).cast("long")}
    return Links(links.withColumns(nothing), list(keys), 0, True, small)


def matched_facts(filtered: DataFrame, links: Links, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Rows of the filtered table with the structure rows of their (component, output).

    The structure is broadcast within the budget, so that facts stay where they are; beyond it both are shuffled.
    """
    facts = filtered.select(
        *SERIES, "absolute_time_index", F.col("scenario_index").alias("scenario"), "granular_date", "value"
    )
    unused = [*([] if links.wide else ["_link"]), *(["_mask"] if links.masks <= 1 else [])]
    return lookup_join(facts, links.rows.drop(*unused), SERIES, limits, links.small)


def _masked(links: Links, number: int) -> Column:
    return F.col("_bit") if links.masks == 1 else F.when(F.col("_mask") == number, F.col("_bit"))


def partial_values(matched: DataFrame, links: Links, grain: dict[str, Column]) -> DataFrame:
    """Partial sums by group and ``grain``, in one pass over the facts, with the masks of the links that were met.

    Only the facts of wide groups are looked at twice: once for the sums and once under their ``_link``, which is null
    in rows of sums.
    """
    sums = {
        "_total": F.sum(F.col("value") * F.col("copies")),
        "_counted": F.sum(F.when(F.col("value").isNotNull(), F.col("copies"))),
        "_date": F.max("granular_date"),  # one date per time index
    } | {f"_met{i}": F.bit_or(_masked(links, i)) for i in range(links.masks)}
    rows = matched.withColumns({f"_{name}": column for name, column in grain.items()})
    groups = [*links.keys, "is_avg", *(f"_{name}" for name in grain)]
    if links.wide:
        once, twice = F.array(F.lit(False)), F.array(F.lit(False), F.lit(True))
        rows = rows.withColumn("_as_link", F.explode(F.when(F.col("_bit").isNull(), twice).otherwise(once)))
        only = {name: F.when(~F.col("_as_link"), F.col(name)) for name in groups}
        rows = rows.withColumns(only | {"_link": F.when(F.col("_as_link"), F.col("_link"))})
        groups = [*groups, "_link"]
    return rows.groupBy(*groups).agg(*[column.alias(name) for name, column in sums.items()])


def _unmet(links: Links, partial: DataFrame) -> DataFrame:
    """Links without a single fact."""
    narrow, wide = links.rows, None
    if links.wide:
        met = partial.filter("_link IS NOT NULL").select("_link")
        wide = links.rows.filter("_bit IS NULL").join(met, "_link", "left_anti")
        narrow = links.rows.filter("_bit IS NOT NULL")
    if not links.masks:
        return wide
    masks = [f"_met{i}" for i in range(links.masks)]
    sums = partial.filter("_link IS NULL") if links.wide else partial
    met = sums.groupBy(*links.keys).agg(*[F.bit_or(name).alias(name) for name in masks])
    mask = F.coalesce(*[F.when(F.col("_mask") == i, F.col(name)) for i, name in enumerate(masks)], F.lit(0).cast("long"))
    narrow = narrow.join(met, links.keys, "left").filter(mask.bitwiseAND(F.col("_bit")) == 0).drop(*masks)
    return narrow if wide is None else narrow.unionByName(wide.select(*narrow.columns))


def grouped_values(
    filtered: DataFrame, links: Links, grain: dict[str, Column], limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """The keys, ``is_avg``, ``grain``, ``value`` (sum or mean) and ``granular_date``: the right outer join of
    the facts with the staged structure rows, aggregated.

    Spark cannot broadcast the preserved side of an outer join, and a second read of the facts
    would be needed to find structure rows without any. So the one pass over them also returns which
    structure rows it met; its result, already aggregated, is staged, and the others are added
    with null grain.
    """
    partial = stage(partial_values(matched_facts(filtered, links, limits), links, grain), "partial")
    nulls = {name: F.lit(None).cast(partial.schema[f"_{name}"].dataType) for name in (*grain, "total", "counted", "date")}
    missing = _unmet(links, partial).select(
        *links.keys, "is_avg", *[column.alias(f"_{name}") for name, column in nulls.items()]
    )
    sums = (partial.filter("_link IS NULL") if links.wide else partial).select(*missing.columns)
    # The shuffle of the fact pass has summed up every group. Only rows of no grain, those of constants, can meet
    # rows that are added here, so they alone are grouped again.
    constant = reduce(Column.__and__, [F.col(f"_{name}").isNull() for name in grain])
    groups = [*links.keys, "is_avg", *(F.col(f"_{name}").alias(name) for name in grain)]
    value = terms_value(F.col("_total"), F.col("_counted"), F.col("is_avg"))
    dated = sums.filter(~constant).select(*groups, value.alias("value"), F.col("_date").alias("granular_date"))
    value = terms_value(F.sum("_total"), F.sum("_counted"), F.col("is_avg"))
    rest = sums.filter(constant).unionByName(missing).groupBy(*groups)
    return dated.unionByName(rest.agg(value.alias("value"), F.max("_date").alias("granular_date")))


def terms_values(filtered: DataFrame, links: Links, *limits) -> DataFrame:
    """Sum or mean per group, time index and scenario."""
    grain = {"absolute_time_index": F.col("absolute_time_index"), "scenario": F.col("scenario")}
    return grouped_values(filtered, links, grain, *limits).withColumnRenamed("value", "granular_metric_value")


def time_values(granular: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum per group, scenario and date."""
    return granular.groupBy(*keys, "scenario", F.col("granular_date").alias("view_date")).agg(
        zero_sum(F.col("granular_metric_value")).alias("metric_value")
    )


def view_values(filtered: DataFrame, links: Links, *limits) -> DataFrame:
    """Terms and time aggregation in one, for when each date has at most one time index
    or all metrics are sums. The terms stage's grain is then the view's, or sums of sums."""
    grain = {"scenario": F.col("scenario"), "view_date": F.col("granular_date")}
    values = grouped_values(filtered, links, grain, *limits).drop("granular_date")
    return values.withColumn("metric_value", F.coalesce("value", F.lit(0.0))).drop("value")


def _as_links(structure: DataFrame) -> DataFrame:
    links = structure.withColumn("is_avg", F.col("terms_operator") == "avg").drop(
        "terms_operator", "weight_output_id", "location_problem", "mentions"
    )
    if "copies" not in links.columns:
        links = links.withColumn("copies", F.lit(1))
    return links


def aggregate_terms(filtered: DataFrame, structure: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Granular metric view of every metric in ``structure``; the facts are read here.

    ``structure`` has the structure columns and ``terms_operator``; ``catalog_key`` and
    ``copies`` are used where present.
    """
    keys = [k for k in METRIC_GROUP if k in structure.columns]
    extra = [k for k in keys if k not in GRANULAR_COLUMNS]
    links = _as_links(structure).withColumn("_group_id", F.xxhash64(*keys))
    links = links.withColumn("_link", F.monotonically_increasing_id())
    links, measured = stage_measured(
        links,
        "links",
        first=F.min("output"),
        last=F.max("output"),
        bytes=F.coalesce(F.sum(row_bytes(links.drop(*keys))), F.lit(0)),
    )
    if measured["first"] is not None:
        filtered = filtered.filter(F.col("output").between(measured["first"], measured["last"]))
    groups, kinds = group_table(links, "_group_id", keys)
    if kinds["clashes"]:  # two groups share a fingerprint: their texts are the key
        return terms_values(filtered, unmasked_links(links.drop("_group_id"), keys), limits).select(*extra, *GRANULAR_COLUMNS)
    masked = masked_links(links.drop(*keys), "_group_id", groups, kinds, measured["bytes"] <= limits.broadcast_bytes)
    values = terms_values(filtered, masked, limits)
    few = kinds["bytes"] <= limits.broadcast_bytes
    return lookup_join(values, groups.drop("_links"), ["_group_id"], limits, few).select(*extra, *GRANULAR_COLUMNS)


def aggregate_time(granular: DataFrame, time_operator: str = "sum") -> DataFrame:
    """Temporal metric view: sums of the granular values by date. Means are not supported."""
    if time_operator != "sum":
        raise NotImplementedError(f"Unsupported time operator {time_operator}, only sum is supported")
    keys = [k for k in METRIC_GROUP if k in granular.columns]
    extra = [k for k in keys if k not in VIEW_COLUMNS]
    return time_values(granular, keys).select(*extra, *VIEW_COLUMNS)
