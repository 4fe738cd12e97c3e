"""The view in its plain form: per reference one right outer join and two group-bys.

For comparison only: it shuffles the fact table once per reference.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import viewloom as vl
from viewloom import Study
from viewloom.functions import zero_sum
from viewloom.operators.references import parse_references, resolve_references
from viewloom.schemas import VIEW_COLUMNS

GROUP = ["metric_id", "metric_location", "breakdown_properties"]


def plain_filter(study: Study) -> DataFrame:
    dates = study.calendar.select(
        "absolute_time_index", F.col("block").cast("string").alias("_block"), "granular_date"
    )
    timed = study.simulation.join(dates, "absolute_time_index").filter(F.col("block").cast("string") == F.col("_block"))
    no_date = F.lit(None).cast(study.calendar.schema["granular_date"].dataType).alias("granular_date")
    constant = study.simulation.filter(F.col("absolute_time_index").isNull()).select("*", no_date)
    return timed.select(*study.simulation.columns, "granular_date").unionByName(constant)


def naive_view(study: Study) -> DataFrame:
    filtered = plain_filter(study)
    bag = vl.study_structure(study).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    resolved = resolve_references(parse_references(study.references), study.metrics)
    views = []
    for reference in resolved.orderBy("pos").collect():
        structure = bag.filter(
            (F.col("catalog_key") == reference["catalog_key"]) & (F.col("metric_id") == reference["metric_id"])
        )
        terms = F.avg("value") if reference["terms_operator"] == "avg" else zero_sum(F.col("value"))
        granular = (
            filtered.join(structure, ["component", "output"], "right")
            .groupBy(*GROUP, "absolute_time_index", F.col("scenario_index").alias("scenario"))
            .agg(terms.alias("granular_metric_value"), F.first("granular_date", ignorenulls=True).alias("view_date"))
        )
        views.append(
            granular.groupBy(*GROUP, "scenario", "view_date")
            .agg(zero_sum(F.col("granular_metric_value")).alias("metric_value"))
            .select(*VIEW_COLUMNS)
        )
    return reduce(DataFrame.unionByName, views)
