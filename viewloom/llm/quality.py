"""Document quality by histogram gradient-boosted trees over statistics of the whole text.

Statistics are computed in one pass of vectorised tasks. Trees are grown from histograms of at most 64
bins a statistic, on a bounded sample of labelled rows (``max_rows``, the smallest hashes of the id,
so the same rows every time; an id that is repeated gives one row). A forest is four flat arrays; all trees are walked at once, one level
of all of them a step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.text import Block, blocks, owners, pair, span_hashes, split_words

MAX_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
RIDGE = 1.0
LEAST_WEIGHT = 1.0

# Classes of bytes: lower, upper, digit, space, line end, sentence mark, exclamation, symbol, other ASCII, first of
# several bytes, further byte
CLASSES = 11
_CLASS = np.full(256, 8, np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 32]], _CLASS[10:14] = 0, 1, 2, 3, 4
_CLASS[[ord(c) for c in ".,;:?"]], _CLASS[ord("!")] = 5, 6
_CLASS[[ord(c) for c in "#$%&*@^~|<>{}[]\\/=+_"]] = 7
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 9, 10

_LINE_END = np.zeros(256, bool)
_LINE_END[10:14] = True


def _distinct_share(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values over values of each text, and the share of its most frequent value."""
    share, top = np.ones((2, len(bounds) - 1))
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if b > a:
            own = np.sort(hashes[a:b])
            at = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            share[i] = len(at) / (b - a)
            top[i] = np.diff(np.append(at, b - a)).max() / (b - a)
    return share, top


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[bounds])


def statistics(block: Block) -> np.ndarray:
    """One row of statistics for each text; an empty or null text has a row too."""
    n = len(block)
    counts = np.bincount(
        owners(block.bounds) * CLASSES + _CLASS[block.data], minlength=n * CLASSES
    ).reshape(n, CLASSES)
    size = np.diff(block.bounds)
    chars = size - counts[:, 10]
    words = split_words(block.data, block.bounds)
    lengths = (words.ends - words.starts).astype(np.float64)
    n_words = np.diff(words.bounds)
    some = np.maximum(n_words, 1)
    mean = _sums(lengths, words.bounds) / some
    spread = np.sqrt(np.maximum(_sums(lengths**2, words.bounds) / some - mean**2, 0))
    hashes = span_hashes(block.data, words.starts, words.ends)
    text = owners(words.bounds)
    same = np.zeros(len(hashes))
    if len(hashes) > 1:
        same[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    kinds = _CLASS[block.data]
    last = kinds[words.ends - 1] if len(hashes) else np.zeros(0, np.uint8)
    first = kinds[words.starts] if len(hashes) else last
    share, top = _distinct_share(hashes, words.bounds)
    triples = np.zeros(len(hashes), np.uint64)
    if len(hashes) > 2:
        triples[:-2] = pair(pair(hashes[:-2], hashes[1:-1]), hashes[2:])
    triple_share, _ = _distinct_share(triples, np.stack([words.bounds[:-1], np.maximum(words.bounds[1:] - 2, words.bounds[:-1])], 1).ravel()) if n else (share, top)
    triple_share = triple_share[::2] if n else triple_share
    lines = split_words(block.data, block.bounds, _LINE_END)
    line_hashes = span_hashes(block.data, lines.starts, lines.ends)
    line_share, line_top = _distinct_share(line_hashes, lines.bounds)
    n_lines = np.diff(lines.bounds)
    whole = np.maximum(chars, 1)
    return np.column_stack(
        [
            np.log1p(chars),
            np.log1p(n_words),
            mean,
            spread,
            share * np.log1p(n_words),
            share,
            top,
            triple_share,
            _sums(same, words.bounds) / some,
            _sums(first == 1, words.bounds) / some,
            _sums((last >= 5) & (last <= 8), words.bounds) / some,
            _sums(last == 6, words.bounds) / some,
            _sums(last == 7, words.bounds) / some,
            _sums((first != 0) & (first != 1) & (first != 9), words.bounds) / some,
            np.log1p(n_lines),
            line_share,
            line_top,
            chars / np.maximum(n_lines, 1),
            *(counts[:, :10] / whole[:, None]).T,
        ]
    ).astype(np.float64)


@dataclass
class Forest:
    """Complete binary trees: node i has children 2i + 1 and 2i + 2; leaves carry values at the last level."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros((len(x), len(self.feature)), np.int64)
        tree = np.arange(len(self.feature))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.threshold[tree, at])
        total = self.base + self.value[tree, at - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """A forest for labels 0 and 1; without rows of both labels it has no trees and scores the share of 1."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    share = y.mean() if len(y) else 0.5
    base = float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3))))
    trees = TREES if 0 < share < 1 and len(y) > 1 else 0
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    value = np.zeros((trees, leaves))
    if not trees:
        return Forest(feature, threshold, value, base)
    columns = x.shape[1]
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(columns)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f]) for f in range(columns)])
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, weight = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            width, start = 2**level, 2**level - 1
            best = np.zeros(width)
            for f in range(columns):
                cell = node * BINS + binned[f]
                s = np.bincount(cell, slope, width * BINS).reshape(width, BINS).cumsum(1)
                w = np.bincount(cell, weight, width * BINS).reshape(width, BINS).cumsum(1)
                s_all, w_all = s[:, -1:], w[:, -1:]
                gain = s**2 / (w + RIDGE) + (s_all - s) ** 2 / (w_all - w + RIDGE) - s_all**2 / (w_all + RIDGE)
                gain[(w < LEAST_WEIGHT) | (w_all - w < LEAST_WEIGHT)] = 0
                gain = gain[:, : len(edges[f])]
                if not gain.shape[1]:
                    continue
                cut = gain.argmax(1)
                better = gain[np.arange(width), cut] > best + 1e-9
                for i in np.flatnonzero(better):
                    best[i] = gain[i, cut[i]]
                    feature[t, start + i], threshold[t, start + i] = f, edges[f][cut[i]]
            at = start + node
            node = 2 * node + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        s, w = np.bincount(node, slope, leaves), np.bincount(node, weight, leaves)
        value[t] = RATE * s / (w + RIDGE)
        total += value[t, node]
    return Forest(feature, threshold, value, base)


def remainder(doc_id: str, divisor: int) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(divisor))


def _training(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        x = statistics(block)
        kept = [block.rows.column(n) for n in ("doc_id", "label")]
        yield pa.RecordBatch.from_arrays([*kept, pa.array([row.tobytes() for row in x], pa.binary())], ["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, held_out: int = 5, max_rows: int = MAX_ROWS) -> Forest:
    """A forest learnt from labelled documents whose crc32(doc_id as text) mod ``held_out`` is not 0.

    Where an id has several labels the smallest counts. At most ``max_rows`` ids are learnt from, one row of
    each, so no number of repeated rows outweighs the others or reaches the driver.
    """
    known = labels.where((remainder("doc_id", held_out) != 0) & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = texts.select(F.col("doc_id").cast("string").alias("doc_id"), "text", "label")
    found = texts.mapInArrow(_training, "doc_id string, label int, x binary")
    rows = found.groupBy("doc_id", "label").agg(F.min("x").alias("x")).toArrow()
    x = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float64)
    x = x.reshape(rows.num_rows, -1) if rows.num_rows else np.zeros((0, 1))
    y = np.asarray(rows.column("label").to_numpy(), np.float64)
    order = np.lexsort(np.column_stack([y, x]).T)  # rows come in any order; sums must not depend on it
    return grow(x[order], y[order])


def _scoring(forest: Forest):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            scores = forest.scores(statistics(block))
            kept = [block.rows.column(n) for n in ("doc_id", "held_out")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], ["doc_id", "held_out", "score"])

    return task


def score_quality(docs: DataFrame, forest: Forest, held_out: int = 5, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (1 from ``threshold`` up).

    One row per row of ``docs`` (doc_id, text; other columns are ignored). Null and empty texts are
    scored like a text without characters. A null id is not held out. Repeated rows score alike, and
    an empty table gives an empty result. A text of any length is read whole, in memory of about 20 bytes a byte of
    the longest one.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder("doc_id", held_out) == 0, F.lit(False)).alias("held_out"),
        "text",
    )
    scored = rows.mapInArrow(_scoring(forest), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, forest: Forest, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score ``threshold`` or more."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            yield block.rows.filter(pa.array(forest.scores(statistics(block)) >= threshold))

    return docs.mapInArrow(task, docs.schema)
