"""Aggregate expressions with the null rules of the metric model.

A sum over nothing but nulls is 0.0, a mean over nothing but nulls is null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zero_sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0.0))


def terms_value(total: Column, counted: Column, is_avg: Column) -> Column:
    """Sum or plain mean from the sum of the values and the number of those that are not null.

    ``is_avg`` has to be a grouping column. Both operators come out of the same two partial
    sums, so a batch of mixed metrics needs a single aggregation.
    """
    return F.when(is_avg, total / counted).otherwise(F.coalesce(total, F.lit(0.0)))
