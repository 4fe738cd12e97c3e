"""Near-duplicate documents by MinHash with tensored banding, links confirmed on full shingle sets.

A document's set holds its distinct shingles of five words. Two small collections of ``TUPLES`` tuples of
``HASHES`` minhashes are computed; a table key is one tuple of the first collection with one of the
second, so ``2 * TUPLES * HASHES`` minhashes give ``TUPLES ** 2`` tables. With 10 tuples of 3, a pair of
similarity 0.85 misses all tables with probability 0.00015; at 0.9 it is 0.000004.

Equal sets are one node. In each table key, all nodes are compared with one leader first, the node that
shares most keys with others (of a text and its near copies, the text itself); a key whose nodes then
lie in one component needs no more. For the others an exact bound comes first: only shingles that occur in
another component too can be common with a node there; they are counted in ``PARTS`` parts by hash,
and two nodes share at most the sum, over the parts, of the smaller of their counts. Copies with edits
of their own fall out here. Rounds of up to ``LEADERS`` leaders compare what is left across components,
a pair in the first of its common tables only, until no key holds two components with nodes that
were not compared. A large group of near copies thus costs its size, not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.components import components
from viewloom.llm.shared import Staging, keyed, sized, texts_of
from viewloom.llm.text import ASCII_LOWER, blocks, column, mix, pair, run_hashes, span_hashes, split_words

SHINGLE_WORDS = 5
TUPLES = 10
HASHES = 3
LEADERS = 4096
PARTS = 32
SIGNATURE = "doc long, key long, n_shingles long, node long, check long, a array<long>, b array<long>"
SETS = "node long, items array<long>"


def shingle_sets(data: np.ndarray, bounds: np.ndarray, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """The sorted distinct shingle identifiers of each text; fewer words than a shingle's make one."""
    data = ASCII_LOWER[data]
    at = split_words(data, bounds)
    hashes = span_hashes(data, at.starts, at.ends)
    shingles = run_hashes(hashes, words)
    out = []
    for a, b in zip(at.bounds[:-1].tolist(), at.bounds[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(shingles[a : b - words + 1]))
        elif b > a:
            out.append(mix(run_hashes(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    odd = mix(np.arange(1, 2 * TUPLES * HASHES + 1, dtype=np.uint64)) | np.uint64(1)
    add = mix(odd + np.uint64(99))
    for block in blocks(batches):
        sets = shingle_sets(block.data, block.bounds)
        sizes = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        node, check = np.zeros((2, len(sets)), np.uint64)
        tuples = np.zeros((2 * TUPLES, len(sets)), np.uint64)
        if len(full):
            items = np.concatenate(sets)
            at = np.cumsum(np.append(0, sizes[full]))[:-1]
            node[full] = mix(np.add.reduceat(mix(items ^ np.uint64(0x51ED270B)), at) + sizes[full].astype(np.uint64))
            check[full] = np.add.reduceat(mix(items + np.uint64(0x2545F491)), at)
            for t in range(2 * TUPLES):
                out = np.full(len(full), t, np.uint64)
                for h in range(t * HASHES, (t + 1) * HASHES):
                    out = pair(out, np.minimum.reduceat(items * odd[h] + add[h], at))
                tuples[t, full] = out
        flat = tuples.T.view(np.int64)
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(x).ravel()), TUPLES).cast(pa.list_(pa.int64()))
            for x in (flat[:, :TUPLES], flat[:, TUPLES:])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                block.rows.column("doc"),
                block.rows.column("key"),
                pa.array(sizes),
                column(node, pa.int64()),
                column(check, pa.int64()),
                *lists,
            ],
            ["doc", "key", "n_shingles", "node", "check", "a", "b"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in blocks(batches):
        sets = shingle_sets(block.data, block.bounds)
        ends = np.cumsum([0] + [len(s) for s in sets])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), column(np.concatenate(sets), pa.int64()))
        yield pa.RecordBatch.from_arrays([block.rows.column("node"), lists], ["node", "items"])


class _Links:
    """Confirms pairs of nodes on their full sets; remembers what was compared."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, percent: int, staging: Staging):
        self.docs, self.nodes, self.percent, self.staging = docs, nodes, percent, staging
        self.compared = None

    def candidates(self, some: DataFrame) -> DataFrame:
        some = some.join(self.nodes.select("node", "n_shingles", "doc", "key"), "node")
        return self.staging.write(some, "candidates")

    def sets_of(self, some: DataFrame) -> DataFrame:
        """``node``, ``items`` (its shingles) of candidates."""
        texts = texts_of(self.docs, some.select("node", "doc", "key"), 64, self.staging).select("node", "text")
        return self.staging.write(texts.mapInArrow(_sets, SETS), "sets")

    def enough(self, common: Column, n_x: Column | str, n_y: Column | str) -> Column:
        return 100 * common >= self.percent * (F.col(n_x) + F.col(n_y) - common)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Compares ``pairs`` (``x`` < ``y``) that were not compared yet; returns those similar enough."""
        if self.compared is not None:
            pairs = pairs.join(self.compared, ["x", "y"], "left_anti")
        pairs = self.staging.write(pairs, "pairs")
        some = self.candidates(pairs.select(F.explode(F.array("x", "y")).alias("node")).distinct())
        sets = self.sets_of(some)
        both = pairs
        for side in ("x", "y"):
            sizes = some.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"))
            both = both.join(sized(sizes, 32), side)
        both = both.where(self.enough(F.least("n_x", "n_y"), "n_x", "n_y"))
        for side in ("x", "y"):
            both = both.join(sets.select(F.col("node").alias(side), F.col("items").alias(f"items_{side}")), side)
        common = F.size(F.array_intersect("items_x", "items_y"))
        both = both.select("x", "y", "n_x", "n_y", common.alias("common"))
        linked = self.staging.write(both.where(self.enough(F.col("common"), "n_x", "n_y")).select("x", "y"), "linked")
        self.compared = pairs if self.compared is None else self.compared.unionByName(pairs)
        self.staging.drop(sets)
        return linked

    def reach(self, nodes: DataFrame, items: DataFrame) -> DataFrame:
        """``node``, ``n`` (its shingles), ``c`` (those that ``items`` has in another component too), ``c0`` ... (these
        by part) and ``ta0`` ... (its tuples).

        ``nodes`` has ``node`` and ``root``. Nodes that cannot be similar enough to any node of another
        component are left out: their shingles number n, the common ones are those counted at most, and
        no union is smaller than n.
        """
        rows = self.staging.write(items.join(nodes, "node"), "rooted")
        shared = rows.groupBy("item").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        shared = self.staging.write(shared.where("low < high").select("item"), "shared")
        part = F.pmod(F.xxhash64("item"), F.lit(PARTS))
        counted = [F.count_if(F.col("part") == i).alias(f"c{i}") for i in range(PARTS)]
        counts = rows.join(shared, "item", "left_semi").withColumn("part", part).groupBy("node").agg(*counted)
        tuples = [F.col(x)[i].alias(f"t{x}{i}") for x in "ab" for i in range(TUPLES)]
        counts = counts.join(self.nodes.select("node", F.col("n_shingles").alias("n"), *tuples), "node")
        counts = counts.withColumn("c", sum(_counts()))
        return self.staging.write(counts.where(100 * F.col("c") >= self.percent * F.col("n")), "able")


def _counts(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}c{i}") for i in range(PARTS)]


def _first_table(prefix: str) -> Column:
    """Whether the key's table (``i``, ``j``) is the first in which both nodes of a pair have equal tuples."""
    earlier = F.lit(False)
    for x, at in (("a", "i"), ("b", "j")):
        for k in range(TUPLES):
            earlier = earlier | ((F.col(at) > k) & (F.col(f"t{x}{k}") == F.col(f"{prefix}t{x}{k}")))
    return ~earlier


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("x"), F.greatest(a, b).alias("y")]


def _grouped(docs: DataFrame, percent: int, staging: Staging) -> DataFrame:
    """``doc``, ``key``, ``n_shingles`` and ``root`` (one for all rows of a group) of each row, staged."""
    signatures = staging.write(docs.mapInArrow(_signatures, SIGNATURE), "signatures")
    with_words = signatures.where("n_shingles > 0")
    nodes = with_words.groupBy("node", "check", "n_shingles").agg(F.min(F.struct("doc", "key", "a", "b")).alias("r"))
    nodes = staging.write(nodes.select("node", "n_shingles", "r.*"), "nodes")

    first = nodes.select("node", "b", F.posexplode("a").alias("i", "value"))
    shared = first.groupBy("i", "value").count().where("count > 1").select("i", "value")
    first = first.join(shared, ["i", "value"], "left_semi")
    tables = first.select("node", "i", "value", F.posexplode("b").alias("j", "other"))
    # a table's number is part of its key: the last byte
    number = F.col("i") * TUPLES + F.col("j")
    key = F.xxhash64("value", "other").bitwiseAND(F.lit(-256)) + number
    tables = staging.write(tables.select("node", key.alias("table_key")), "tables")

    groups = tables.groupBy("table_key").agg(F.count("*").alias("n"), F.min("node").alias("x"), F.max("node").alias("y"))
    groups = staging.write(groups.where("n > 1"), "groups")
    larger = staging.write(groups.where("n > 2").select("table_key", "n"), "larger")
    rows = staging.write(tables.join(larger, "table_key"), "rows")
    staging.drop(tables)
    weight = staging.write(rows.groupBy("node").agg(F.sum("n").alias("weight")), "weight")
    rows = staging.write(rows.join(weight, "node").select("table_key", "node", "weight"), "rows")
    leaders = rows.groupBy("table_key").agg(F.max(F.struct("weight", "node")).alias("leader"))
    leaders = staging.write(leaders.select("table_key", F.col("leader.node").alias("leader")), "leaders")
    rows = staging.write(rows.join(leaders, "table_key").where("node != leader").select("table_key", "node", "leader"), "rows")
    links = _Links(docs, nodes, percent, staging)
    star = rows.select(*_ordered("leader", "node"))
    linked = links.confirm(groups.where("n = 2").select("x", "y").unionByName(star).distinct())
    labels = components(linked, staging)

    def open_rows(rows: DataFrame) -> DataFrame:
        """The rows, with ``root``, of table keys that hold two components, and ``size``, the key's rows."""
        at = rows.drop("root", "size").join(labels, "node", "left")
        at = staging.write(at.withColumn("root", F.coalesce("root", "node")), "at")
        sizes = at.groupBy("table_key").agg(
            F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        sizes = staging.write(sizes.where("low < high").select("table_key", "size"), "open")
        return staging.write(at.join(sizes, "table_key"), "rows")

    rows, turn, items = rows.select("table_key", "node"), 0, None
    while True:
        rows, turn = open_rows(rows), turn + 1
        if rows.isEmpty():
            break
        now = staging.write(rows.select("node", "root").distinct(), "now")
        if items is None:
            sets = links.sets_of(links.candidates(now.select("node")))
            items = sets.select("node", F.explode("items").alias("item"))
            items = staging.write(items, "items")
        rows = rows.select("table_key", "node").join(links.reach(now, items), "node")
        rows = open_rows(staging.write(rows, "able"))
        if rows.isEmpty():
            break
        chance = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 20)) / F.lit(float(1 << 20))
        rows = staging.write(rows.withColumn("leads", chance * F.col("size") < LEADERS), "led")
        leaders = rows.where("leads").drop("leads", "size")
        leaders = leaders.select("table_key", *[F.col(x).alias(f"l_{x}") for x in leaders.columns if x != "table_key"])
        common = sum(F.least(x, y) for x, y in zip(_counts(), _counts("l_")))
        number = F.pmod("table_key", F.lit(256))
        both = rows.withColumn("i", F.floor(number / TUPLES)).withColumn("j", F.pmod(number, F.lit(TUPLES)))
        across = both.join(leaders, "table_key").where(
            (F.col("root") != F.col("l_root"))
            & (~F.col("leads") | (F.col("node") < F.col("l_node")))  # two leaders meet once
            & links.enough(F.least("c", "l_c"), "n", "l_n")  # the cheap tests first
            & _first_table("l_")
            & links.enough(common, "n", "l_n")
        )
        labels = components(links.confirm(across.select(*_ordered("l_node", "node")).distinct()), staging, labels)
        rows = rows.where("not leads").select("table_key", "node")

    everything = signatures.select("doc", "key", "n_shingles", "node").join(labels, "node", "left")
    return staging.write(everything.withColumn("root", F.coalesce("root", "node")), "everything")


def near_duplicate_groups(docs: DataFrame, percent: int = 85) -> DataFrame:
    """For each row: doc_id, n_shingles, component_id (smallest id reachable over links) and kept.

    Texts are lower-cased (A-Z) and split into runs of characters other than space and ``\\t`` to
    ``\\r``. Two documents are linked if ``100 * intersection >= percent * union`` of their shingle sets.
    A document without words (or text) has an empty set and is linked with nothing.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). Rows with equal sets are
    linked whatever their ids. A null id counts as larger than all others; a component of such rows
    alone has a null component_id. ``kept`` says that doc_id is the component's, both null included.
    An empty table gives an empty result. Sets are named by 64-bit hashes. A text of any length is read whole, in
    memory of about 20 bytes a byte of the longest one.
    """
    docs = keyed(docs, "doc_id", "text")
    staging = Staging(docs.sparkSession, "near-dedup")
    everything = _grouped(docs, percent, staging)
    least = everything.where("n_shingles > 0").groupBy("root").agg(F.min("doc").alias("least"))
    least = staging.write(least, "least")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc"))
    no_id = F.lit((1 << 63) - 1)
    return everything.join(least, "root", "left").select(
        F.nullif("doc", no_id).alias("doc_id"),
        "n_shingles",
        F.nullif(component, no_id).alias("component_id"),
        (F.col("doc") == component).alias("kept"),
    )


def one_of_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each group, all columns as they are: the smallest id, of equal ids the smallest hash.

    Rows without words stay, each on its own; rows that repeat id and text become one.
    """
    rows = docs.withColumnsRenamed({"doc": "its doc", "key": "its key"}) if {"doc", "key"} & set(docs.columns) else docs
    own = keyed(rows, *rows.columns)
    staging = Staging(docs.sparkSession, "one-of-each")
    everything = _grouped(own.select("doc_id", "text", "doc", "key"), percent, staging)
    first = everything.where("n_shingles > 0").groupBy("root").agg(F.min(F.struct("doc", "key")).alias("r"))
    kept = first.select("r.doc", "r.key").unionByName(everything.where("n_shingles = 0").select("doc", "key").distinct())
    found = texts_of(own, staging.write(kept, "kept"), 48, staging)
    return found.select(*[F.col(f"`{r}`").alias(c) for r, c in zip(rows.columns, docs.columns)])
