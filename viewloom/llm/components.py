"""Connected components of a graph whose edges stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging

#: A graph of so many edges at most is contracted in one task, without shuffles; its size is counted first.
FEW_EDGES = 50_000


def _roots(parents: DataFrame, staging: Staging, few: bool) -> DataFrame:
    """``node``, ``root`` of a forest given as ``node``, ``root``. Each round makes pointers four times as long."""
    while True:
        jumped = parents
        for _ in range(2):
            further = jumped.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = jumped.join(further, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        jumped = _placed(staging.write(jumped, "jumped"), few)
        if jumped.join(parents.select(F.col("node").alias("root")), "root", "left_semi").isEmpty():
            return jumped  # all point to nodes that have no parent
        parents = jumped


def _placed(table: DataFrame, few: bool) -> DataFrame:
    return table.coalesce(1) if few else table


def _moved(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The edges between the roots of their ends, each once."""
    for side in ("x", "y"):
        to = roots.select(F.col("node").alias(side), F.col("root").alias("next"))
        edges = edges.join(to, side, "left").withColumn(side, F.coalesce("next", side)).drop("next")
    edges = edges.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return edges.where("x < y").distinct()


def components(edges: DataFrame, staging: Staging, labels: DataFrame | None = None) -> DataFrame:
    """``node``, ``root`` (the smallest node reachable) for each node of ``edges`` (``x``, ``y``) but the roots.

    ``labels`` are the components of edges that were there before, if any. Each round hooks every
    node that has a smaller neighbour to its smallest one, follows the hooks to their roots and
    contracts the edges to roots, until none is left. Rows are aggregated before they are
    shuffled, so a node with many neighbours collapses where its edges are.
    """
    if labels is None:
        labels = edges.select(F.col("x").alias("node"), F.col("y").alias("root")).limit(0)
    edges = staging.write(_moved(edges, labels), "edges")
    few = edges.count() <= FEW_EDGES
    edges = _placed(edges, few)
    found = None
    while not edges.isEmpty():
        hooks = staging.write(edges.groupBy(F.col("y").alias("node")).agg(F.min("x").alias("root")), "hooks")
        roots = _roots(_placed(hooks, few), staging, few)
        if found is not None:
            to = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            roots = found.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root")).unionByName(roots)
            roots = _placed(staging.write(roots, "found"), few)
        found = roots
        edges = _placed(staging.write(_moved(edges, roots), "edges"), few)
    if found is None:
        return labels
    to = found.select(F.col("node").alias("root"), F.col("root").alias("next"))
    before = labels.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return staging.write(before.unionByName(found), "labels")
