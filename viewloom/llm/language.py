"""Language of whole texts: nearest of several clustered centroids per language, by cosine.

A text is a vector of its letter 1- to 3-grams, hashed into ``WIDTH`` cells, as normalised TF-IDF. Each
language has up to ``clusters`` centroids, found by spherical k-means on a bounded sample of labelled
rows (``max_rows`` in expectation, spread evenly over the languages, chosen by a hash of id and text; rows that
repeat both are one row).
The nearest centroid names the language; a text further from it than nearly all texts that it was
learnt from is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.text import Block, blocks, code_points, letters, mix, owners

WIDTH = 4096
MAX_ROWS = 2_000
CLUSTERS = 4
ROUNDS = 12
TEXTS_A_BLOCK = 256
UNKNOWN = "und"


def gram_counts(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed 1- to 3-grams of letters for each text, and whether it has a letter."""
    points, bounds = code_points(block)
    points = letters(points)
    text = owners(bounds)
    n = len(block)
    counts = np.zeros(n * WIDTH)
    ids = points.astype(np.uint64)
    for size in (1, 2, 3):
        if len(points) < size:
            break
        if size > 1:
            ids = ids[:-1] * np.uint64(0x110000) + points[size - 1 :]
        last = len(points) - size + 1
        inside = (text[:last] == text[size - 1 :]) & (points[:last] != 32)
        if size == 3:
            inside &= points[1:-1] != 32
        cell = (mix(ids[inside] + np.uint64(size)) >> np.uint64(52)).astype(np.int64)
        counts += np.bincount(text[:last][inside] * WIDTH + cell, minlength=n * WIDTH)
    has = np.bincount(text[points != 32], minlength=n) > 0
    return counts.reshape(n, WIDTH), has


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    """``centroids``: unit vectors; ``language``: the number in ``names`` of each; ``least``: its smallest cosine."""

    names: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    language: np.ndarray
    least: np.ndarray

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cosine = self.vectors(counts) @ self.centroids.T
        best = cosine.argmax(1)
        return best, cosine[np.arange(len(best)), best]


def _clusters(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from the mean and the points furthest from what was chosen before."""
    chosen = [x.mean(0)]
    for _ in range(min(k, len(x)) - 1):
        near = np.max(x @ _unit(np.array(chosen)).T, axis=1)
        chosen.append(x[near.argmin()])
    centroids = _unit(np.array(chosen))
    for _ in range(ROUNDS):
        own = (x @ centroids.T).argmax(1)
        sums = np.stack([x[own == i].sum(0) if (own == i).any() else centroids[i] for i in range(len(centroids))])
        centroids = _unit(sums)
    return centroids


def fit(names: np.ndarray, counts: np.ndarray, clusters: int = CLUSTERS, outliers: float = 0.005) -> Model:
    """A model from labelled gram counts; rejects what is further off than all but ``outliers`` of them."""
    known = sorted(set(names.tolist()))
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))) + 1
    x = _unit(np.log1p(counts) * idf)
    centroids, language, least = [], [], []
    for i, name in enumerate(known):
        own = x[names == name]
        found = _clusters(own, clusters)
        cosine = own @ found.T
        for c in range(len(found)):
            near = cosine[cosine.argmax(1) == c, c]
            least.append(np.quantile(near, outliers) if len(near) else 1.0)
        centroids.append(found)
        language += [i] * len(found)
    width = counts.shape[1]
    return Model(known, idf, np.concatenate(centroids) if centroids else np.zeros((0, width)), np.array(language), np.array(least))


def remainder(doc_id: str, divisor: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(divisor))


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches, most=TEXTS_A_BLOCK):
        counts, has = gram_counts(block)
        counts = counts[has].astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [block.rows.column("lang").filter(pa.array(has)), pa.array([c.tobytes() for c in counts], pa.binary())],
            ["lang", "counts"],
        )


def train(docs: DataFrame, divisor: int = 4, held_out: int = 2, max_rows: int = MAX_ROWS, clusters: int = CLUSTERS) -> Model:
    """A model learnt from text and non-null lang of rows whose crc32(doc_id as text) mod 4 is not 2."""
    known = docs.where((remainder("doc_id", divisor) != held_out) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = known.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("doc_id", "text"), 0.01).alias("n")).collect()
    shares = [(r["lang"], max_rows / len(sizes) / r["n"]) for r in sizes]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, share double")
    chance = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.join(F.broadcast(shares), "lang").where(chance < F.col("share"))
    sample = sample.select("doc_id", "lang", "text").distinct()
    rows = sample.select("lang", "text").mapInArrow(_training, "lang string, counts binary").toArrow()
    names = np.array(rows.column("lang").to_pylist(), dtype=object)
    counts = np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.float32).reshape(-1, WIDTH).astype(np.float64)
    order = np.lexsort((counts @ np.sin(np.arange(WIDTH)), names.astype(str))) if len(names) else slice(0)
    return fit(names[order], counts[order], clusters)


def _predicting(model: Model):
    names = np.array([*model.names, UNKNOWN], dtype=object)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, most=TEXTS_A_BLOCK):
            counts, has = gram_counts(block)
            which = np.full(len(block), len(model.names))
            score, rejected = np.zeros(len(block)), np.ones(len(block), bool)
            if len(model.centroids):
                best, cosine = model.nearest(counts)
                which = np.where(has, model.language[best], which)
                score = np.where(has, np.clip(cosine, 0, 1), 0)
                rejected = ~has | (cosine < model.least[best])
            kept = [block.rows.column(n) for n in ("doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(names[which], pa.string()), pa.array(score), pa.array(rejected)],
                ["doc_id", "held_out", "lang_pred", "score", "rejected"],
            )

    return task


def predict(docs: DataFrame, model: Model, divisor: int = 4, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score (cosine to the nearest centroid, 0 to 1) and rejected.

    lang_pred is the nearest centroid's language, for a rejected text too; ``und`` with score 0 for a
    text that is null or has no letter, or if nothing was learnt. ``rejected`` marks those, and texts
    whose cosine is below that of nearly all texts of the centroid's cluster.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). A null id is not held out.
    Repeated rows are predicted alike; an empty table gives an empty result. A text of any length is one vector and is
    read whole, in memory of about 25 bytes a byte of the longest one.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder("doc_id", divisor) == held_out, F.lit(False)).alias("held_out"),
        "text",
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"
    return rows.mapInArrow(_predicting(model), schema)
