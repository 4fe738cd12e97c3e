"""Nearest neighbours by p-stable hashing with query-directed multiprobe and exact reranking.

A table files a vector under ``floor((a . v + b) / w)`` for a few random Gaussian directions ``a``. A query
visits its own bucket and then perturbed ones, in the order of their estimated success: the smaller
the sum of squared distances from the query to the bucket borders that a perturbation crosses, the
likelier a near vector lies there. Every row is in every table. The width ``w`` and the number of probes
are set on a bounded sample (``SAMPLE_ROWS`` rows), so that probing finds ``RECALL`` of the sample's own
nearest neighbours.

Vectors may lie denser in some places than in others, so every query is judged by what it found: for Gaussian
directions, the chance that a vector at a given distance lies in none of the probed buckets is known.
A query that may have missed more than ``RECALL`` allows is compared with all rows.

Buckets are split into blocks of bounded size on both sides, and a block of rows meets a block of
queries in one task, which returns each query's nearest ids of that block only. The lists of all tables
are merged and ranked by exact distance.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging, sized

TABLES = 4
HASHES = 4
STEPS = 3
SAMPLE_ROWS = 4_000
SAMPLE_QUERIES = 64
RECALL = 0.96
MOST_PROBES = 512
BLOCK_ROWS = 4_096
BLOCK_QUERIES = 1_024
KEYS = ["table", "bucket"]


@dataclass
class Hashing:
    """``directions``: dimension x (tables * hashes); ``offsets`` in units of ``width``; ``probes`` a table."""

    directions: np.ndarray
    offsets: np.ndarray
    width: float
    probes: int

    def places(self, x: np.ndarray) -> np.ndarray:
        """rows x tables x hashes, in units of the width."""
        return (x @ self.directions / self.width + self.offsets).reshape(len(x), TABLES, HASHES)


def perturbations(fraction: np.ndarray, most: int) -> list[tuple[float, np.ndarray]]:
    """Up to ``most`` perturbations of a bucket, likeliest first, for a query at ``fraction`` in it."""
    moves = []
    for j, f in enumerate(fraction.tolist()):
        for step in range(1, STEPS + 1):
            moves += [((f + step - 1) ** 2, j, -step), ((step - f) ** 2, j, step)]
    moves.sort()
    out = [(0.0, np.zeros(len(fraction), np.int64))]
    todo = [(moves[0][0], (0,))]
    while todo and len(out) < most:
        cost, chosen = heapq.heappop(todo)
        used = [moves[i][1] for i in chosen]
        if len(set(used)) == len(used):
            shift = np.zeros(len(fraction), np.int64)
            for i in chosen:
                shift[moves[i][1]] = moves[i][2]
            out.append((cost, shift))
        last = chosen[-1]
        if last + 1 < len(moves):
            heapq.heappush(todo, (cost - moves[last][0] + moves[last + 1][0], (*chosen[:-1], last + 1)))
            heapq.heappush(todo, (cost + moves[last + 1][0], (*chosen, last + 1)))
    return out


def expected_recall(fractions: np.ndarray, probes: int, far: np.ndarray) -> float:
    """Mean chance that vectors at distances ``far``, in widths, lie in a probed bucket of some table.

    ``fractions`` is tables x hashes: where in its buckets the query lies. Offsets are uniform, so these say
    nothing of the directions, and a vector at distance d is off by d times a standard normal number in each hash.
    """
    borders = np.arange(-STEPS, STEPS + 2)
    spread = np.maximum(far, 1e-9)[:, None, None] * math.sqrt(2)
    missed = np.ones(len(far))
    for fraction in fractions:
        below = 0.5 * (1 + _erf((borders - fraction[:, None]) / spread))
        within = np.diff(below, axis=-1)  # distances x hashes x steps
        shifts = np.array([shift for _, shift in perturbations(fraction, probes)]) + STEPS
        missed *= 1 - np.prod([within[:, j, shifts[:, j]] for j in range(len(fraction))], axis=0).sum(axis=-1)
    return float(1 - missed.mean())


_erf = np.vectorize(math.erf, otypes=[float])


def bucket_ids(cells: np.ndarray) -> np.ndarray:
    """One 64-bit number for each row of whole numbers: their low bits side by side."""
    bits = 64 // HASHES
    low = (cells.astype(np.int64) & ((1 << bits) - 1)).astype(np.uint64)
    return (low << (np.arange(HASHES, dtype=np.uint64) * np.uint64(bits))).sum(axis=-1, dtype=np.uint64).view(np.int64)


def _distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - q) ** 2).sum(axis=-1))


def fit(sample: np.ndarray, k: int = 10, seed: int = 11) -> Hashing:
    """Width and probes that find ``RECALL`` of the k nearest within the sample."""
    rng = np.random.default_rng(seed)
    n, dimension = sample.shape
    hashing = Hashing(rng.normal(size=(dimension, TABLES * HASHES)), rng.random(TABLES * HASHES), 1.0, 1)
    if n < 2:
        return hashing
    queries = np.arange(0, n, max(1, n // SAMPLE_QUERIES))
    near, reach = [], []
    for q in queries:
        far = _distances(sample, sample[q])
        far[q] = np.inf
        near.append(np.argsort(far, kind="stable")[: min(k, n - 1)])
        reach.append(far[near[-1][-1]])
    hashing.width = 0.9 * float(np.median(reach)) or 1.0
    places = hashing.places(sample)
    cells = np.floor(places).astype(np.int64)
    first = np.full((len(queries), near[0].size), MOST_PROBES)  # the first probe that finds the neighbour
    for i, q in enumerate(queries):
        for t in range(TABLES):
            order = perturbations(places[q, t] - cells[q, t], MOST_PROBES)
            rank = {tuple(shift): r for r, (_, shift) in enumerate(order)}
            for j, v in enumerate(near[i]):
                first[i, j] = min(first[i, j], rank.get(tuple(cells[v, t] - cells[q, t]), MOST_PROBES))
    probes = 8
    while probes < MOST_PROBES and (first < probes).mean() < RECALL:
        probes *= 2
    hashing.probes = probes
    return hashing


def _matrix(column: pa.ListArray, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.float64).reshape(-1, dimension)


def _entries(hashing: Hashing, dimension: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            cells = bucket_ids(np.floor(hashing.places(_matrix(rows.column("v"), dimension))))
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("v"), pa.array(np.full(rows.num_rows, t), pa.int32()), pa.array(cells[:, t])],
                    ["id", "v", "table", "bucket"],
                )

    return task


def _probes(hashing: Hashing, dimension: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 16):
                rows = batch.slice(first, 16)
                places = hashing.places(_matrix(rows.column("v"), dimension))
                cells = np.floor(places).astype(np.int64)
                at, table, bucket = [], [], []
                for i in range(rows.num_rows):
                    for t in range(TABLES):
                        shifts = np.array([s for _, s in perturbations(places[i, t] - cells[i, t], hashing.probes)])
                        bucket.append(bucket_ids(cells[i, t] + shifts))
                        at.append(np.full(len(shifts), i))
                        table.append(np.full(len(shifts), t))
                take = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("vec_id").take(take),
                        rows.column("v").take(take),
                        pa.array(np.concatenate(table), pa.int32()),
                        pa.array(np.concatenate(bucket)),
                    ],
                    ["id", "v", "table", "bucket"],
                )

    return task


def _doubtful(hashing: Hashing, dimension: int, k: int):
    """Keeps the queries that found fewer than k, or too few for sure at the distances (``far``) found."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                rows = batch.slice(first, 1024)
                places = hashing.places(_matrix(rows.column("v"), dimension))
                fractions, keep = places - np.floor(places), []
                for i, far in enumerate(rows.column("far").to_pylist()):
                    keep.append(
                        far is None
                        or len(far) < k
                        or expected_recall(fractions[i], hashing.probes, np.array(far) / hashing.width) < RECALL
                    )
                yield rows.select(["vec_id"]).filter(pa.array(keep, pa.bool_()))

    return task


def _firsts(ids: np.ndarray) -> np.ndarray:
    """Where each run of equal ids begins."""
    return np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))


def _nearest_of_block(k: int):
    def task(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if rows.empty or queries.empty:
            return empty
        x, q = (np.stack(f["v"].to_numpy()).astype(np.float64) for f in (rows, queries))
        ids, own = rows["id"].to_numpy(), queries["id"].to_numpy()
        x_norms = (x**2).sum(1)
        scale = np.finfo(np.float64).eps * 64 * x.shape[1]
        order = np.argsort(ids, kind="stable")
        x, x_norms, ids = x[order], x_norms[order], ids[order]
        out = []
        for i in range(len(q)):
            others = np.flatnonzero(ids != own[i])
            if not len(others):
                continue
            # a rough distance picks those that can be among the k nearest; they are measured exactly
            rough = x_norms[others] - 2 * (x[others] @ q[i])
            least = np.minimum.reduceat(rough, _firsts(ids[others]))  # of each id, whose rows stand together
            if len(least) > k:
                slack = scale * (x_norms.max() + q[i] @ q[i])
                others = others[rough <= np.partition(least, k - 1)[k - 1] + slack]
            far = _distances(x[others], q[i])
            best = np.lexsort((far, ids[others]))
            best = best[_firsts(ids[others][best])]  # the nearest row of each id
            best = best[np.lexsort((ids[others][best], far[best]))[:k]]
            out.append(pd.DataFrame({"query_id": own[i], "vec_id": ids[others][best], "score": far[best]}))
        return pd.concat(out) if out else empty

    return task


def _met_in_blocks(entries: DataFrame, probes: DataFrame, k: int, staging: Staging) -> DataFrame:
    """Each query's ``k`` nearest of every block of rows in the buckets that it probes."""
    sizes = entries.groupBy(*KEYS).agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / BLOCK_ROWS))
    asked = probes.groupBy(*KEYS).agg(F.count("*").alias("m")).withColumn("asks", F.ceil(F.col("m") / BLOCK_QUERIES))
    splits = staging.write(sizes.join(asked, KEYS).select(*KEYS, "parts", "asks"), "splits")
    splits = sized(splits, 64)
    rows = entries.join(splits, KEYS).select(
        *KEYS,
        F.pmod(F.xxhash64("id", "v"), "parts").alias("part"),
        F.explode(F.sequence(F.lit(0), F.col("asks") - 1)).alias("ask"),
        "id",
        "v",
    )
    asks = probes.join(splits, KEYS).select(
        *KEYS,
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.pmod(F.xxhash64("id"), "asks").alias("ask"),
        "id",
        "v",
    )
    block = [*KEYS, "part", "ask"]
    met = rows.groupBy(*block).cogroup(asks.groupBy(*block))
    return met.applyInPandas(_nearest_of_block(k), "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's ``k`` nearest vectors found, its own id left out.

    The score is the Euclidean distance in double precision; ties go to the smaller id. A query with
    fewer than ``k`` found is compared with all rows, so it lacks some only if there are no more; so is a
    query that probing is expected to leave below ``RECALL`` at the distances it found.

    ``vectors`` and ``queries`` have vec_id and embedding; other columns are ignored. Rows whose id is null,
    and vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    vectors of another dimension than most rows have (the smaller if tied). Rows that repeat an id
    count once, with their nearest vector. Empty tables give an empty result.
    """
    spark = vectors.sparkSession
    staging = Staging(spark, "ann")

    def usable(df: DataFrame) -> DataFrame:
        v = F.transform("embedding", lambda e: e.cast("double"))
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL")
        finite = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
        return df.where(finite & F.exists("v", lambda e: e != 0))

    rows = staging.write(usable(vectors).distinct(), "rows")
    widths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], schema)
    dimension = widths["d"]
    rows = rows.where(F.size("v") == dimension)
    asked = staging.write(usable(queries).where(F.size("v") == dimension), "queries")
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").toArrow()
    hashing = fit(_matrix(sample.column("v").combine_chunks(), dimension), k)

    filed = "id long, v array<double>, table int, bucket long"
    entries = rows.mapInArrow(_entries(hashing, dimension), filed)
    probes = asked.mapInArrow(_probes(hashing, dimension), filed)
    found = staging.write(_met_in_blocks(entries, probes, k, staging), "found")

    reach = _best(found, k).groupBy(F.col("query_id").alias("vec_id")).agg(F.collect_list("score").alias("far"))
    judged = asked.join(reach, "vec_id", "left").select("vec_id", "v", "far")
    short = judged.mapInArrow(_doubtful(hashing, dimension, k), "vec_id long").distinct()
    short = staging.write(asked.join(short, "vec_id", "left_semi"), "short")
    if not short.isEmpty():
        whole = [F.col("vec_id").alias("id"), "v", F.lit(0).alias("table"), F.lit(0).cast("long").alias("bucket")]
        found = found.unionByName(_met_in_blocks(rows.select(*whole), short.select(*whole), k, staging))
    return _best(found, k)
