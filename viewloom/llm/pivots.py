"""Exact top-k search by largest integer inner product, with pivot-table elimination.

A row x gets one more component, so that all rows have the length of the longest one; the query gets a
zero there. The inner product with a query then falls as the angle between the two grows, and angles are
a metric. ``PIVOTS`` rows, chosen far apart from a bounded sample, serve as pivots: the table of all rows'
angles to them is computed once and staged. For a query q and a row x the largest of
``|angle(q, p) - angle(x, p)|`` over all pivots p is a lower bound of their angle, and so an upper bound of
the score.

Rows are filed under their nearest pivot, in blocks of bounded size; so are queries, but pivots with few queries
share a block. A block of rows meets a block
of queries in one task, unless the range of its angles to its own pivot rules out all of them. There each
query takes the rows in the order of their bounds and stops at the first that cannot beat the k-th
score it has. It starts from the k-th score within the sample. No row is left out but by its bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging, sized

PIVOTS = 64
SAMPLE_ROWS = 2_000
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 512
#: Rows that a query measures at once, in the order of their bounds.
STRIDE = 512
#: Radians by which a computed angle may be off: the table holds 32-bit floats, and an arc cosine near 1 loses digits.
SLACK = 1e-6
SCHEMA = "query_id long, rank int, vec_id long, score long"


@dataclass
class Pivots:
    """``directions``: pivots x (dimension + 1), of length 1. ``longest``: the length of the longest row."""

    directions: np.ndarray
    longest: float

    def angles(self, x: np.ndarray, as_query: bool) -> np.ndarray:
        """Angles to all pivots; a zero query is given a right angle to all, as all its scores are 0."""
        unit = unit_rows(x, self.longest, as_query)
        return np.arccos(np.clip(unit @ self.directions.T, -1, 1)).astype(np.float32)


def unit_rows(x: np.ndarray, longest: float, as_query: bool = False) -> np.ndarray:
    """Rows with the added component, scaled to length 1."""
    x = x.astype(np.float64)
    if as_query:
        norms = np.sqrt((x**2).sum(1, keepdims=True))
        return np.hstack([x / np.where(norms > 0, norms, 1), np.zeros((len(x), 1))])
    x = x / (longest or 1.0)
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x**2).sum(1, keepdims=True)))])


def choose_pivots(sample: np.ndarray, longest: float, most: int = PIVOTS) -> Pivots:
    """Up to ``most`` rows of the sample, each the farthest from those before it."""
    unit = unit_rows(sample, longest)
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(most, len(unit)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return Pivots(unit[chosen], longest)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dimension)


def _products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: through doubles where no sum can pass their 53 bits."""
    largest = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if largest < 2**53:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best by score, then smaller id; an id counts once, with its highest score."""
    order = np.lexsort((ids, -scores))
    _, first = np.unique(ids[order], return_index=True)
    order = order[np.sort(first)][:k]
    return ids[order], scores[order]


def _table(pivots: Pivots, dimension: int):
    """Adds the angles to all pivots and the nearest pivot (``cell``)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if rows.num_rows:
                far = pivots.angles(_matrix(rows.column("v"), dimension), as_query=False)
                yield _with_angles(rows, far)

    return task


def _with_angles(rows: pa.RecordBatch, far: np.ndarray, **more: pa.Array) -> pa.RecordBatch:
    ends = pa.array(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1])
    angles = pa.ListArray.from_arrays(ends, pa.array(far.ravel()))
    columns = {"vec_id": rows.column("vec_id"), "v": rows.column("v"), "cell": pa.array(far.argmin(1).astype(np.int32))}
    return pa.RecordBatch.from_pydict(columns | {"far": angles} | more)


def _asked(pivots: Pivots, dimension: int, ids: np.ndarray, sample: np.ndarray, k: int):
    """Queries with their angles, the k-th score within the sample (``floor``), and the angle (``reach``)
    beyond which no row has that score."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                rows = batch.slice(first, 1024)
                x = _matrix(rows.column("v"), dimension)
                floors, reach = [], []
                for own, q in zip(rows.column("vec_id").to_pylist(), x):
                    _, scores = best_of(ids[ids != own], _products(sample[ids != own], q), k)
                    floors.append(int(scores[-1]) if len(scores) == k else None)
                    span = float(np.sqrt((q.astype(np.float64) ** 2).sum())) * pivots.longest
                    known = floors[-1] is not None and span > 0
                    reach.append(float(np.arccos(np.clip(floors[-1] / span, -1, 1))) if known else np.pi)
                far = pivots.angles(x, as_query=True)
                yield _with_angles(rows, far, floor=pa.array(floors, pa.int64()), reach=pa.array(reach, pa.float64()))

    return task


def _best_of_block(longest: float, k: int):
    def task(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            x, far = np.stack(rows["v"].to_numpy()), np.stack(rows["far"].to_numpy())
            ids = rows["vec_id"].to_numpy()
            for own, v, angles, floor in zip(queries["vec_id"], queries["v"], queries["far"], queries["floor"]):
                q = np.asarray(v, np.int64)
                span = float(np.sqrt((q.astype(np.float64) ** 2).sum())) * longest
                least = np.abs(far - np.asarray(angles, np.float32)).max(1).astype(np.float64)
                bound = span * (np.cos(np.maximum(0, least - SLACK)) + SLACK)
                kth = -np.inf if pd.isna(floor) else float(floor)
                order = np.flatnonzero((ids != own) & (bound >= kth))
                order = order[np.argsort(-bound[order], kind="stable")]
                best, scores = ids[:0], np.zeros(0, np.int64)
                for first in range(0, len(order), STRIDE):
                    if bound[order[first]] < kth:  # all that follow are bounded as low
                        break
                    some = order[first : first + STRIDE]
                    best, scores = best_of(np.append(best, ids[some]), np.append(scores, _products(x[some], q)), k)
                    if len(scores) == k:
                        kth = max(kth, float(scores[-1]))
                found.append(pd.DataFrame({"query_id": own, "vec_id": best, "score": scores}))
        kinds = {"query_id": "int64", "vec_id": "int64", "score": "int64"}
        return pd.concat(found).astype(kinds) if found else pd.DataFrame({c: [] for c in kinds}).astype(kinds)

    return task


def _block_pairs(rows: DataFrame, queries: DataFrame) -> DataFrame:
    """cell, part, qcell, qpart: the pairs of blocks that the pivot of the rows does not rule out.

    A block of rows is met with each block of queries by the rows' own pivot, to which both have a range of angles.
    """
    own = F.get("far", F.col("cell"))
    blocks = rows.groupBy("cell", "part").agg(F.min(own).alias("low"), F.max(own).alias("high"))
    angles = queries.select("qcell", "qpart", "reach", F.posexplode("far").alias("cell", "angle"))
    asks = angles.groupBy("qcell", "qpart", "cell").agg(
        F.min("angle").alias("qlow"), F.max("angle").alias("qhigh"), F.max("reach").alias("reach")
    )
    apart = F.greatest(F.col("low") - F.col("qhigh"), F.col("qlow") - F.col("high"))
    pairs = blocks.join(asks, "cell").where(apart <= F.col("reach") + 2 * SLACK)
    return pairs.select("cell", "part", "qcell", "qpart")


def _in_parts(table: DataFrame, cell: str, part: str, most: int) -> DataFrame:
    """Each cell's rows dealt into parts of about ``most`` by a hash of the row, so that no cell is one group."""
    sizes = table.groupBy(cell).agg(F.ceil(F.count("*") / F.lit(most)).alias("_parts"))  # one row a pivot
    dealt = table.join(F.broadcast(sizes), cell)
    return dealt.withColumn(part, F.pmod(F.xxhash64("vec_id", "v"), "_parts").cast("int")).drop("_parts")


def _merged(table: DataFrame, cell: str, most: int) -> DataFrame:
    """Cells that follow each other share the first one's number as long as they have ``most`` rows together at most."""
    leads, lead, filled = [0] * PIVOTS, 0, most
    for row in table.groupBy(cell).count().orderBy(cell).collect():  # one row a pivot
        if filled + row["count"] > most:
            lead, filled = row[cell], 0
        filled += row["count"]
        leads[row[cell]] = lead
    return table.withColumn(cell, F.get(F.lit(leads), F.col(cell)).cast("int"))


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` rows of the largest inner product, its own id left out.

    Components are whole numbers, ``floor(scale * x)``; scores are exact. Ties go to the smaller id. A query
    with fewer than ``k`` candidates has them all.

    ``vectors`` and ``queries`` have vec_id and embedding; other columns are ignored. Rows whose id is null, and
    vectors that are null, empty or hold null or non-finite components take no part, nor do vectors of another
    dimension than most rows have (the smaller if tied). Zero vectors take part, with scores of 0. Rows that repeat
    an id count once, with their highest score. Empty tables give an empty result. Components so large that a score
    could pass 64 bits raise a ``ValueError``.
    """
    spark = vectors.sparkSession
    staging = Staging(spark, "pivots")

    def usable(df: DataFrame) -> DataFrame:
        e = F.transform("embedding", lambda e: e.cast("double"))
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("e")).where("vec_id IS NOT NULL")
        finite = F.forall("e", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
        df = df.where((F.size("e") > 0) & finite)
        largest = F.array_max(F.transform("e", lambda e: F.abs(e * scale))).alias("largest")
        return df.select("vec_id", F.transform("e", lambda e: F.floor(e * scale)).alias("v"), largest)

    rows = staging.write(usable(vectors).distinct(), "rows")
    wanted = staging.write(usable(queries).distinct(), "queries")
    size = F.size("v").alias("d")
    largest = [r.groupBy(size).agg(F.max("largest").alias("largest"), F.count("*").alias("n")) for r in (rows, wanted)]
    dimensions = largest[0].orderBy(F.desc("n"), "d").first()
    if dimensions is None:
        return spark.createDataFrame([], SCHEMA)
    dimension = dimensions["d"]
    asked = largest[1].where(F.col("d") == dimension).first()
    if dimension * (dimensions["largest"] + 1) * (max(dimensions["largest"], asked["largest"] if asked else 0) + 1) >= 2**63:
        raise ValueError("components are so large that an inner product could pass 64 bits")
    rows, wanted = (r.where(F.size("v") == dimension).drop("largest") for r in (rows, wanted))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    longest = rows.agg(F.sqrt(F.max(square)).alias("longest")).first()["longest"]
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE_ROWS).toArrow().combine_chunks()
    ids, seeds = (sample.column(c).combine_chunks() for c in ("vec_id", "v"))
    ids, seeds = np.asarray(ids), _matrix(seeds, dimension)
    pivots = choose_pivots(seeds, longest)

    schema = "vec_id long, v array<long>, cell int, far array<float>"
    table = staging.write(rows.mapInArrow(_table(pivots, dimension), schema), "table")
    asks = wanted.mapInArrow(_asked(pivots, dimension, ids, seeds, k), schema + ", floor long, reach double")
    asks = staging.write(asks.withColumnRenamed("cell", "qcell"), "asks")
    table = _in_parts(table, "cell", "part", BLOCK_ROWS)
    asks = _in_parts(_merged(asks, "qcell", BLOCK_QUERIES), "qcell", "qpart", BLOCK_QUERIES)
    pairs = sized(staging.write(_block_pairs(table, asks), "pairs"), 64)
    block = ["cell", "part", "qcell", "qpart"]
    met = table.join(pairs, ["cell", "part"]).groupBy(*block).cogroup(asks.join(pairs, ["qcell", "qpart"]).groupBy(*block))
    found = met.applyInPandas(_best_of_block(longest, k), "query_id long, vec_id long, score long")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
