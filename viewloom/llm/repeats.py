"""Which windows of L consecutive symbols also occur elsewhere, found without comparing pairs.

Every window is filed under one content-defined *seed*: the q symbols with the smallest hash in it
(winnowing; the leftmost if equal). Equal windows have equal seeds at equal offsets, so only places
that share a seed need a look. The windows of one seed at offsets from o1 to o2 have in common a
*core* (what all of them hold) and lie in a *span* (what any of them holds):

* a core that occurs once settles them all: no such window occurs elsewhere;
* a span that occurs twice settles them all: each such window occurs elsewhere;
* otherwise the offsets are split and the parts are judged the same way, down to single windows.

Each step groups by identifiers and is linear in its rows. A group of copies of any size collapses in
the partial aggregation, and splits work at the ends of matches only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging, sized, texts_of
from viewloom.llm.text import Block, blocks, column, mix, owners, pair, run_hashes

POSITION_BITS = 28

RUNS = "doc long, key long, anchor int, block int, core long, span long, low int, high int"
SNIPPETS = "core0 long, span0 long, size long, first long, before int, block int, data binary"
REGIONS = "doc long, key long, regions array<struct<start: int, end: int>>"
PARTS = "core0 long, span0 long, size long, first long, parent long, core long, span long, low int, high int, part int"


@dataclass(frozen=True)
class Shape:
    """``length`` symbols a window, ``seed`` symbols a seed, ``steps``: offsets judged together."""

    length: int
    seed: int
    steps: tuple[int, ...]

    @property
    def offsets(self) -> int:
        return self.length - self.seed + 1


class Ladder:
    """Identifiers of substrings, from identifiers of its first and last 2**k symbols."""

    def __init__(self, symbols: np.ndarray, least: int, most: int, seed: int | None = None):
        self.rungs, self.seeds = {}, None
        ids, k = symbols, 0
        while True:
            if (1 << k) == seed:
                self.seeds = ids
            if (2 << k) > least:
                self.rungs[k] = ids
            if (2 << k) > most or len(ids) <= (1 << k):
                break
            ids = pair(ids[: -(1 << k)], ids[1 << k :])
            k += 1
        if seed and self.seeds is None:  # a length between two rungs
            self.seeds = run_hashes(symbols, seed)

    def ids(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sizes = ends - starts
        out = np.zeros(len(starts), np.uint64)
        rung = np.frexp(sizes)[1] - 1
        for k in np.unique(rung):
            at = rung == k
            table = self.rungs[int(k)]
            out[at] = pair(table[starts[at]], table[ends[at] - (1 << int(k))])
        return mix(out + sizes.astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: -(width - have)], values[width - have :]) if have < width else values


def seeds_of_windows(seeds: np.ndarray, bounds: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all whole windows, and the position of each one's seed, given what each position's seed would be."""
    if len(seeds) < shape.offsets:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    low, most = np.uint64(POSITION_BITS), 1 << POSITION_BITS
    anchors = []
    for first in range(0, len(seeds) - shape.offsets + 1, most - shape.offsets + 1):  # positions must fit their bits
        part = seeds[first : first + most]
        order = (mix(part) >> low << low) | np.arange(len(part), dtype=np.uint64)
        anchors.append((sliding_min(order, shape.offsets) & np.uint64(most - 1)).astype(np.int64) + first)
    anchors = np.concatenate(anchors)
    starts = np.arange(len(anchors))
    whole = starts + shape.length <= bounds[1:][owners(bounds)[: len(anchors)]]
    return starts[whole], anchors[whole]


def extents(anchor: np.ndarray, block: np.ndarray, step: int, shape: Shape):
    """First and last offset of the blocks; starts and ends of their cores and of their unclipped spans."""
    first = block * step
    last = np.minimum(first + step, shape.offsets) - 1
    return first, last, anchor - first, anchor - last + shape.length, anchor - last, anchor - first + shape.length


def runs_of_block(symbols: np.ndarray, bounds: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """The runs of windows that share a seed and a block of offsets; positions count from the block's start."""
    step = shape.steps[0]
    ladder = Ladder(symbols, shape.length - step + 1, shape.length + step - 1, shape.seed)
    starts, anchor = seeds_of_windows(ladder.seeds, bounds, shape)
    block = (anchor - starts) // step
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(anchor) != 0) | (np.diff(block) != 0)
    at = np.flatnonzero(new)
    text = owners(bounds)[anchor[at]] if len(at) else at
    low, high = starts[at], starts[np.append(at[1:], len(starts)) - 1] if len(at) else at
    anchor, block = anchor[at], block[at]
    _, _, a, b, c, d = extents(anchor, block, step, shape)
    c, d = np.maximum(c, bounds[:-1][text]), np.minimum(d, bounds[1:][text])
    where = pair((anchor - c).astype(np.uint64), block.astype(np.uint64))
    return {
        "text": text,
        "anchor": anchor,
        "block": block,
        "core": pair(ladder.ids(a, b), block.astype(np.uint64)) if len(at) else np.zeros(0, np.uint64),
        "span": pair(ladder.ids(c, d), where) if len(at) else np.zeros(0, np.uint64),
        "low": low,
        "high": high,
    }


Symbols = Callable[[Block], tuple[np.ndarray, np.ndarray, Callable[[int, int], bytes]]]


def _runs(symbols_of: Symbols, shape: Shape):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            symbols, bounds, _ = symbols_of(block)
            runs = runs_of_block(symbols, bounds, shape)
            text = runs.pop("text")
            base = bounds[:-1][text]
            doc = block.rows.column("doc").take(pa.array(text))
            key = block.rows.column("key").take(pa.array(text))
            yield pa.RecordBatch.from_arrays(
                [
                    doc,
                    key,
                    column(runs["anchor"] - base, pa.int32()),
                    column(runs["block"], pa.int32()),
                    column(runs["core"], pa.int64()),
                    column(runs["span"], pa.int64()),
                    column(runs["low"] - base, pa.int32()),
                    column(runs["high"] - base, pa.int32()),
                ],
                ["doc", "key", "anchor", "block", "core", "span", "low", "high"],
            )

    return task


def _snippets(symbols_of: Symbols, shape: Shape):
    """The span around each wanted seed, as symbols' bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            _, bounds, raw = symbols_of(block)
            wanted = block.rows.column("wanted")
            text = owners(np.asarray(wanted.offsets))
            fields = {f.name: np.asarray(wanted.flatten().field(f.name)) for f in wanted.type.value_type}
            base, stop = bounds[:-1][text], bounds[1:][text]
            anchor = fields["anchor"] + base
            _, _, _, _, start, end = extents(anchor, fields["block"].astype(np.int64), shape.steps[0], shape)
            start, end = np.maximum(start, base), np.minimum(end, stop)
            names = ["core0", "span0", "size", "first"]
            yield pa.RecordBatch.from_arrays(
                [column(fields[n], pa.int64()) for n in names]
                + [column(anchor - start, pa.int32()), column(fields["block"], pa.int32())]
                + [pa.array([raw(int(a), int(b)) for a, b in zip(start, end)], pa.binary())],
                names + ["before", "block", "data"],
            )

    return task


def parts_of(before: np.ndarray, block: np.ndarray, bounds: np.ndarray, parts: list[np.ndarray], step: int, shape: Shape):
    """The given parts of each snippet that fit: snippet, part, first and last offset, anchor, place in the input."""
    which = np.repeat(np.arange(len(before)), [len(x) for x in parts])
    part = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    anchor = before[which] + bounds[:-1][which]
    first, last, *_ = extents(anchor, part, step, shape)
    outer = block[which] * shape.steps[0]
    first = np.maximum(first, outer)
    last = np.minimum(last, np.minimum(outer + shape.steps[0], shape.offsets) - 1)
    first = np.maximum(first, anchor + shape.length - bounds[1:][which])
    last = np.minimum(last, anchor - bounds[:-1][which])
    fits = first <= last
    return which[fits], part[fits], first[fits], last[fits], anchor[fits], np.flatnonzero(fits)


def _parts(width: int, expand: Callable[[np.ndarray], np.ndarray], level: int, shape: Shape):
    """Cores and spans of the wanted parts of each snippet, one level finer."""
    step, coarser = shape.steps[level], shape.steps[level - 1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "data"):
            symbols = expand(block.data)
            bounds = block.bounds // width
            rows = block.rows
            before, outer = (np.asarray(rows.column(n)).astype(np.int64) for n in ("before", "block"))
            wanted = pairs_by_row(rows.column("wanted"), "part", "size", "first")
            per = -(-coarser // step)
            todo = [(x[:, :1] * coarser // step + np.arange(per)).ravel() for x in wanted]
            which, part, first, last, anchor, entry = parts_of(before, outer, bounds, todo, step, shape)
            if not len(which):
                continue
            own = np.concatenate(wanted)[entry // per]
            _, _, a, b, c, d = extents(anchor, part, step, shape)
            c, d = np.maximum(c, bounds[:-1][which]), np.minimum(d, bounds[1:][which])
            ladder = Ladder(symbols, shape.length - step + 1, shape.length + step - 1)
            core = ladder.ids(a, b)
            span = pair(ladder.ids(c, d), (anchor - c).astype(np.uint64))
            take = pa.array(which)
            parent = [rows.column(n).take(take) for n in ("core0", "span0")]
            parent += [pa.array(own[:, 1]), pa.array(own[:, 2])]
            yield pa.RecordBatch.from_arrays(
                parent
                + [
                    rows.column("core0").take(take),
                    column(pair(core, part.astype(np.uint64)), pa.int64()),
                    column(span, pa.int64()),
                    column(first, pa.int32()),
                    column(last, pa.int32()),
                    column(part, pa.int32()),
                ],
                ["core0", "span0", "size", "first", "parent", "core", "span", "low", "high", "part"],
            )

    return task


def repeated_windows(
    docs: DataFrame,
    shape: Shape,
    symbols_of: Symbols,
    width: int,
    expand: Callable[[np.ndarray], np.ndarray],
    earlier: bool,
    staging: Staging,
) -> DataFrame:
    """``doc``, ``key``, ``regions`` (array of start, end): what windows that occur elsewhere cover.

    ``earlier``: elsewhere means in a document with a smaller id; otherwise at any other position.
    ``docs`` has ``doc``, ``key`` and ``text``. Documents without such windows have no row.
    """
    runs = staging.write(docs.mapInArrow(_runs(symbols_of, shape), RUNS), "runs")

    def found(size: Column, first: Column, own_first: Column) -> Column:
        return first < own_first if earlier else size >= 2

    # cores that occur once are settled: none of their windows occurs elsewhere
    shared = runs.groupBy("core").agg(F.count("*").alias("n"), F.min("doc").alias("x"), F.max("doc").alias("y"))
    shared = shared.where((F.col("n") > 1) & (F.lit(not earlier) | (F.col("x") < F.col("y")))).select("core")
    # both sides of a join come from tables, so that a skewed key can be split
    shared = staging.write(shared, "shared")
    seen = staging.write(runs.join(shared, "core", "left_semi"), "seen")
    staging.drop(runs)

    classes = staging.write(
        seen.groupBy("core", "span").agg(
            F.count("*").alias("size"),
            F.min("doc").alias("first"),
            F.min(F.struct("doc", "key", "anchor", "block")).alias("rep"),
        ),
        "classes",
    )
    cores = classes.groupBy("core").agg(
        F.count("*").alias("classes"), F.min("first").alias("x"), F.max("first").alias("y")
    )
    cores = cores.where((F.col("classes") > 1) & (F.lit(not earlier) | (F.col("x") < F.col("y"))))
    cores = staging.write(cores.select("core"), "cores")
    classes_of_mixed = staging.write(classes.join(cores, "core", "left_semi"), "mixed")

    members = seen.join(classes.select("core", "span", "size", "first"), ["core", "span"])
    settled = members.where(found(F.col("size"), F.col("first"), F.col("doc"))).select("doc", "key", "low", "high")
    results = [staging.write(settled, "settled")]

    # the others: their windows at the ends of matches
    wanted = classes_of_mixed.select(
        "rep.doc",
        "rep.key",
        F.struct(
            F.col("core").alias("core0"), F.col("span").alias("span0"), "size", "first", "rep.anchor", "rep.block"
        ).alias("w"),
    )
    wanted = staging.write(wanted.groupBy("doc", "key").agg(F.collect_list("w").alias("wanted")), "wanted")
    texts = texts_of(docs, wanted, 48 + 48 * F.size("wanted"), staging).select("text", "wanted")
    snippets = staging.write(texts.mapInArrow(_snippets(symbols_of, shape), SNIPPETS), "snippets")
    whole = F.array(F.struct(F.col("block").alias("part"), "size", "first"))
    todo = snippets.withColumn("wanted", whole).drop("size", "first")
    part = ["core0", "span0", "part"]
    answers = None
    for level in range(1, len(shape.steps)):
        rows = staging.write(todo.mapInArrow(_parts(width, expand, level, shape), PARTS), f"parts{level}")
        groups = rows.groupBy("parent", "core", "span").agg(
            F.sum("size").alias("n"), F.min("first").alias("f"), F.min(F.struct(*part)).alias("rep")
        )
        groups = staging.write(groups, "groups")
        judged = rows.join(groups.select("parent", "core", "span", "n", "f"), ["parent", "core", "span"])
        yes = judged.where(found(F.col("n"), F.col("f"), F.col("first")))
        yes = staging.write(yes.select("core0", "span0", "low", "high"), "yes")
        answers = yes if answers is None else answers.unionByName(yes)
        if level + 1 < len(shape.steps):
            open_cores = groups.groupBy("parent", "core").agg(F.count("*").alias("c"))
            open_cores = staging.write(open_cores.where("c > 1").select("parent", "core"), "open")
            if earlier:
                left = rows.select("parent", "core", "size", "first", *part)
            else:  # a group of several is settled, and one of it stands for all
                left = groups.select("parent", "core", F.col("n").alias("size"), F.col("f").alias("first"), "rep.*")
            left = left.join(open_cores, ["parent", "core"], "left_semi")
            left = left.groupBy("core0", "span0").agg(F.collect_list(F.struct("part", "size", "first")).alias("wanted"))
            todo = snippets.drop("size", "first").join(staging.write(left, "left"), ["core0", "span0"])
        staging.drop(rows, groups)
    if answers is not None:
        # a class's windows are left open only where they begin in its first document
        answers = answers.withColumnsRenamed({"core0": "core", "span0": "span", "low": "o1", "high": "o2"})
        open_classes = classes_of_mixed.where(F.lit(earlier) | (F.col("size") == 1))
        answers = answers.join(open_classes.select("core", "span", F.col("first").alias("doc")), ["core", "span"])
        answers = seen.join(staging.write(answers, "answers"), ["core", "span", "doc"])
        results.append(
            answers.select(
                "doc", "key", (F.col("anchor") - F.col("o2")).alias("low"), (F.col("anchor") - F.col("o1")).alias("high")
            )
        )
    windows = results[0] if len(results) == 1 else results[0].unionByName(results[1])
    windows = windows.groupBy("doc", "key").agg(F.collect_set(F.struct("low", "high")).alias("windows"))
    return staging.write(windows.mapInArrow(_merged(shape.length), REGIONS), "regions")


def _merged(length: int):
    """Windows as the regions they cover: maximal, apart and in order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            if not rows.num_rows:
                continue
            starts, ends, sizes = [], [], [0]
            for windows in pairs_by_row(rows.column("windows"), "low", "high"):
                windows = windows[np.argsort(windows[:, 0], kind="stable")]
                reach = np.maximum.accumulate(windows[:, 1] + length)
                new = np.append(True, windows[1:, 0] > reach[:-1])
                starts.append(windows[new, 0])
                ends.append(reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)])
                sizes.append(len(starts[-1]))
            flat = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x), pa.int32()) for x in (starts, ends)], ["start", "end"]
            )
            regions = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([rows.column("doc"), rows.column("key"), regions], ["doc", "key", "regions"])

    return task


def pairs_by_row(lists: pa.ListArray, *names: str) -> list[np.ndarray]:
    """A column of lists of structs as one array (entries x fields) for each row; null as none."""
    flat = lists.flatten()
    both = np.stack([np.asarray(flat.field(n)).astype(np.int64) for n in names], 1)
    ends = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))])
    return [both[a:b] for a, b in zip(ends[:-1], ends[1:])]


def region_mask(bounds: np.ndarray, regions: list[np.ndarray]) -> np.ndarray:
    """Which symbols of a block lie in one of their text's regions."""
    edge = np.zeros(int(bounds[-1]) + 1, np.int64)
    for base, own in zip(bounds[:-1], regions):
        edge[own[:, 0] + base] += 1
        np.subtract.at(edge, own[:, 1] + base, 1)
    return np.cumsum(edge[:-1]) > 0


def with_regions(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """``docs`` (with ``doc`` and ``key``) and their ``regions``, null where there are none."""
    return docs.join(sized(regions, 64 + 16 * F.size("regions")), ["doc", "key"], "left")
