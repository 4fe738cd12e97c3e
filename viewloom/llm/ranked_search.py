"""Ranked lexical search over posting lists in geometric blocks, exact.

The index holds the terms that the items use. Documents come in chunks of ``CHUNK_DOCS``. Within a chunk they
are ordered by similarity (a signed random projection of their impact vectors, clustered around representatives
chosen far apart), and each term's posting list is cut in that order into blocks of ``BLOCK_DOCS`` similar
documents. A block is stored with the coordinatewise maximum of its documents' impacts: its summary.

An item visits its terms' lists from the rarest term on. A document that holds an earlier term has been met
in that term's list, so in the list of a term only the item's terms from that one on count; the summary of a list
has just those coordinates. The sum of a summary over an item's coordinates is an upper bound of the scores
that the block can still add. A block is skipped only if that bound is below the item's k-th score so far; equal
ones are visited, as ties go to the smaller doc_id. A first share of the chunks is searched to find k-th scores for all
items, from which the rest starts.

A chunk is one group of bounded size whatever its terms are, so the list of a term that all documents hold is
spread over all chunks. Scores are whole numbers, computed as stated in ``search``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging
from viewloom.llm.text import ASCII_LOWER, blocks, mix, owners, span_hashes, split_words

CHUNK_DOCS = 1024
BLOCK_DOCS = 32
REPRESENTATIVES = 32
PROJECTION = 32
#: Items are searched together up to about so many terms, repeats in other items counted.
MOST_TERMS = 8192
#: One chunk in so many is searched first, for the scores that the others have to reach.
FIRST_IN = 16
TEXT_BYTES = 1 << 20
NO_ID = (1 << 63) - 1

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BREAKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])

FORWARD = "chunk long, local int, doc long, n long, terms array<int>, tfs array<int>"
INDEX = "chunk long, term int, members array<int>, maxima array<long>"
FOUND = "item int, doc long, score long"


def _names(terms: list[str]) -> np.ndarray:
    raw = [t.encode() for t in terms]
    ends = np.cumsum([len(r) for r in raw])
    data = np.frombuffer(b"".join(raw), np.uint8)
    return span_hashes(data, np.append(0, ends[:-1]), ends) if raw else np.zeros(0, np.uint64)


def _forward(names: np.ndarray):
    """Each text's number of terms, and how often it holds each term of the vocabulary (64-bit names, sorted)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, seen = TaskContext.get().partitionId() << 32, 0
        for block in blocks(batches, size=TEXT_BYTES):
            data = ASCII_LOWER[block.data]
            words = split_words(data, block.bounds, BREAKS)
            n = np.diff(words.bounds)
            hashes = span_hashes(data, words.starts, words.ends)
            at = np.minimum(np.searchsorted(names, hashes), max(len(names) - 1, 0))
            known = names[at] == hashes if len(names) else np.zeros(len(hashes), bool)
            row, term = owners(words.bounds)[known], at[known]
            pairs, tf = np.unique(row * len(names) + term, return_counts=True)
            row, term = np.divmod(pairs, max(len(names), 1))
            ends = pa.array(np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32))
            place = seen + np.arange(len(n))
            seen += len(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(first + place // CHUNK_DOCS),
                    pa.array((place % CHUNK_DOCS).astype(np.int32)),
                    block.rows.column("doc"),
                    pa.array(n.astype(np.int64)),
                    pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32))),
                ],
                ["chunk", "local", "doc", "n", "terms", "tfs"],
            )

    return task


@dataclass
class Searched:
    """The items of one search in terms of the vocabulary, whose terms are numbered from the rarest on.

    ``wanted[i]``: the numbers of item i's terms, ascending. ``after[t]``: t and the later terms that share an item
    with it, which are the coordinates of its list's summaries.
    """

    weights: np.ndarray
    documents: int
    length: int
    wanted: list[np.ndarray]
    after: list[np.ndarray]

    def impacts(self, rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Documents' ids, and what each term adds to their scores: documents x vocabulary."""
        rows = rows.sort_by("local").combine_chunks()
        terms, tfs = (rows.column(c).combine_chunks() for c in ("terms", "tfs"))
        row = np.repeat(np.arange(rows.num_rows), np.diff(np.asarray(terms.offsets)))
        term, tf = (np.asarray(x.flatten()).astype(np.int64) for x in (terms, tfs))
        n = np.asarray(rows.column("n"))
        if 90 * int(n.max(initial=0)) * self.documents < 1 << 63:
            m = 10 + 90 * n * self.documents // max(self.length, 1)
        else:
            m = np.array([10 + 90 * int(x) * self.documents // self.length for x in n], np.int64)
        out = np.zeros((rows.num_rows, len(self.weights)), np.int64)
        out[row, term] = self.weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[row]))
        return np.asarray(rows.column("doc")), out


def similarity_order(impacts: np.ndarray) -> np.ndarray:
    """Documents in an order that keeps similar ones together: by cluster, and by closeness to its representative."""
    signs = mix(np.arange(impacts.shape[1] * PROJECTION, dtype=np.uint64)).reshape(-1, PROJECTION)
    x = impacts.astype(np.float32) @ np.where(signs >> np.uint64(63), 1, -1).astype(np.float32)
    x /= np.maximum(np.sqrt((x**2).sum(1, keepdims=True)), 1e-9)
    chosen = [0]
    nearest = x @ x[0]
    while len(chosen) < min(REPRESENTATIVES, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    close = x @ x[chosen].T
    cluster = close.argmax(1)
    return np.lexsort((-close[np.arange(len(x)), cluster], cluster))


def _indexed(search: Searched):
    """A chunk's posting lists: members in the order of similarity, and a summary of each block of them."""

    def task(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        _, impacts = search.impacts(rows)
        order = similarity_order(impacts)
        impacts = impacts[order]
        out = {"term": [], "members": [], "maxima": []}
        for term, coordinates in enumerate(search.after):
            members = np.flatnonzero(impacts[:, term])
            if len(members):
                of_list = impacts[np.ix_(members, coordinates)]
                summaries = np.maximum.reduceat(of_list, np.arange(0, len(members), BLOCK_DOCS))
                out["term"].append(term)
                out["members"].append(order[members])
                out["maxima"].append(summaries.ravel())
        return pa.table(
            {
                "chunk": pa.array(np.full(len(out["term"]), chunk), pa.int64()),
                "term": pa.array(out["term"], pa.int32()),
                "members": pa.array(out["members"], pa.list_(pa.int32())),
                "maxima": pa.array(out["maxima"], pa.list_(pa.int64())),
            }
        )

    return task


def _searched(search: Searched, k: int, reached: np.ndarray):
    """Each item's ``k`` best documents of a chunk that may be among its best of all."""

    def task(lists: pa.Table, rows: pa.Table) -> pa.Table:
        doc, impacts = search.impacts(rows)
        index = {}
        columns = [lists.column(c).combine_chunks() for c in ("term", "members", "maxima")]
        for term, members, maxima in zip(*columns):
            term = term.as_py()
            index[term] = np.asarray(members.values), np.asarray(maxima.values).reshape(-1, len(search.after[term]))
        found = []
        for item, wanted in enumerate(search.wanted):
            bounds, blocks_of = [], []
            for i, term in enumerate(wanted):
                if term in index:
                    members, maxima = index[term]
                    coordinates = np.searchsorted(search.after[term], wanted[i:])
                    bounds.append(maxima[:, coordinates].sum(1))
                    blocks_of += [members[a : a + BLOCK_DOCS] for a in range(0, len(members), BLOCK_DOCS)]
            if not bounds:
                continue
            bounds = np.concatenate(bounds)
            least = max(int(reached[item]), 1)  # a score of 0 is none
            order = np.argsort(-bounds, kind="stable")
            order = order[: int((bounds >= least).sum())]
            best, scores, seen, first, stride = doc[:0], np.zeros(0, np.int64), np.zeros(len(doc), bool), 0, 4
            while first < len(order) and bounds[order[first]] >= least:
                met = np.unique(np.concatenate([blocks_of[b] for b in order[first : first + stride]]))
                met = met[~seen[met]]
                seen[met] = True
                best = np.append(best, doc[met])
                scores = np.append(scores, impacts[np.ix_(met, wanted)].sum(1))
                keep = np.lexsort((best, -scores))[:k]
                best, scores = best[keep], scores[keep]
                if len(scores) == k:
                    least = max(least, int(scores[-1]))
                first, stride = first + stride, 2 * stride
            good = scores >= max(int(reached[item]), 1)
            found.append((np.full(good.sum(), item), best[good], scores[good]))
        parts = [np.concatenate(x) if found else np.zeros(0) for x in (zip(*found) if found else [[]] * 3)]
        return pa.table([pa.array(x, t) for x, t in zip(parts, (pa.int32(), pa.int64(), pa.int64()))], ["item", "doc", "score"])

    return task


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_together(docs: DataFrame, items: list, k: int, staging: Staging) -> DataFrame:
    """item (the position in ``items``), rank, doc and score."""
    terms = sorted({t for row in items for t in row["terms"]})
    names = _names(terms)
    by_name = np.argsort(names)
    forward = docs.select("text", "doc").mapInArrow(_forward(names[by_name]), FORWARD)
    forward = staging.write(forward.where("n > 0"), "forward")
    size = forward.agg(F.count("*").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    counts = forward.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    counts = counts.toArrow()  # a row a term of the items at most
    df = np.zeros(len(terms), np.int64)
    df[np.asarray(counts.column("term"))] = np.asarray(counts.column("df"))
    weights = [math.floor(1000 * math.log((2 * size["n"] + 2) / (2 * int(x) + 1))) for x in df]

    place = dict(zip((terms[i] for i in by_name), range(len(terms))))
    wanted = [np.array([place[t] for t in row["terms"]], np.int64) for row in items]
    rank = np.empty(len(terms), np.int64)  # lists are visited from the rarest term on
    rank[np.lexsort((np.arange(len(terms)), df))] = np.arange(len(terms))
    after = [set() for _ in terms]
    for some in wanted:
        for term in some:
            after[term].update(int(u) for u in some if rank[u] >= rank[term])
    by_rank = np.argsort(rank)
    search = Searched(
        np.array(weights, np.int64)[by_rank],
        size["n"],
        size["length"],
        [np.sort(rank[some]) for some in wanted],
        [np.sort(rank[np.array(sorted(after[t]), np.int64)]) for t in by_rank],
    )
    to_rank = F.lit(rank.tolist()) if len(terms) else F.array().cast("array<long>")
    ranked = F.transform("terms", lambda t: F.get(to_rank, t).cast("int"))
    forward = forward.withColumn("terms", ranked)
    index = forward.groupBy("chunk").applyInArrow(_indexed(search), INDEX)
    index = staging.write(index, "index")

    def met(chunks, reached: np.ndarray) -> DataFrame:
        lists, rows = (x.where(chunks).groupBy("chunk") for x in (index, forward))
        found = lists.cogroup(rows).applyInArrow(_searched(search, k, reached), FOUND)
        return staging.write(found, "found")

    early = F.pmod(F.xxhash64("chunk"), F.lit(FIRST_IN)) == 0
    found = met(early, np.zeros(len(items), np.int64))
    reached = np.zeros(len(items), np.int64)
    for row in _best(found, k).where(F.col("rank") == k).select("item", "score").collect():  # a row an item at most
        reached[row["item"]] = row["score"]
    return _best(found.unionByName(met(~early, reached)), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's ``k`` highest-scoring documents, best first.

    Terms are maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased. With N documents that
    have terms, L terms in all of them, n terms in a document and df documents with a term, the term's weight w is
    ``floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, a document's m is ``10 + (90 * n * N) div L``, and the score sums
    ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` over the item's distinct terms, all in whole numbers. Documents
    with a score of 0 are not returned. Ties go to the smaller doc_id.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are ignored. Each row of ``docs`` is a
    document, repeated ones too, so an id may be returned once for each of its rows; a null id ranks after all others.
    Null texts have no terms and no document without terms counts. Items that repeat id and text are one; those with one
    id and other texts are searched on their own. Items without terms, and empty tables, give no rows. A text is read
    whole, in memory of about 60 bytes a byte of the longest one; items are searched about ``MOST_TERMS`` terms at a
    time, an item with more of them alone, in memory of ``8 * CHUNK_DOCS`` bytes a term. Terms are compared by 64-bit names.
    """
    spark = docs.sparkSession
    staging = Staging(spark, "ranked")
    lowered = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    terms = F.array_distinct(F.array_remove(F.split(lowered, BREAK), ""))
    asked = items.select("item_id", "text").distinct().select("item_id", F.xxhash64("item_id", "text").alias("_key"), terms.alias("terms"))
    asked = staging.write(asked.where(F.size("terms") > 0), "items")
    together = math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / MOST_TERMS)
    docs = docs.select(F.col("text").alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"))
    out = asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    for part in range(together):
        some = asked.where(F.pmod(F.col("_key"), F.lit(together)) == part).orderBy("_key", "item_id").select("item_id", "terms")
        rows = some.collect()
        if not rows:
            continue
        ids = spark.createDataFrame([(i, row["item_id"]) for i, row in enumerate(rows)], f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        found = _search_together(docs, rows, k, staging).join(F.broadcast(ids), "item")
        out = out.unionByName(found.select("item_id", "rank", F.nullif("doc", F.lit(NO_ID)).alias("doc_id"), "score"))
    return out
