"""Phrase collocations by SON partitioning: shards mined completely, then one exact count of all candidates.

The documents are dealt into ``SHARDS`` shards. A phrase that a language holds ``least`` times or more is held by some
shard in its share at least: if the shard has m of the language's n words, ``ceil(least * m / n)`` times. So

1. every shard is mined completely at that lowered support: words, then pairs of words that are both frequent in
   the same shard, then all longer phrases whose pairs are;
2. the locally frequent phrases of all shards are united;
3. one more pass counts every one of them over all documents, by its text, and those below ``least`` go.

A shard is mined by as many tasks as its documents fill, whose counts are added up in a shuffle, so that neither a
shard nor a language has to fit into a task. Between passes the tasks are told the frequent phrases as bitmaps of a
fixed size (``FILTER_BITS``): a bit set by another phrase lets some phrases through that need not be counted, but
never stops one. Phrases are named by 64 bits while they are mined; should two share a name, both are kept, and
the last pass tells them apart.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging, sized
from viewloom.llm.text import ASCII_LOWER, blocks, owners, pair, span_hashes, split_words

SHARDS = 4
FILTER_BITS = 27
#: Bytes of text looked at together, bytes hashed together, and counts held by a task before it passes them on.
TEXT_BYTES, HASH_BYTES, MOST_COUNTS = 1 << 20, 1 << 19, 1 << 20
BATCH_ROWS = 1 << 16

PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BREAKS = PIECE_ENDS.copy()
BREAKS[[0x20, 0x09]] = True

MINED = "slot long, lang_id long, gram long, n long"


class Passage:
    """The words of some texts in a row: where they stand, their 64-bit names, and whose they are.

    ``follows[i]``: word i stands in the same piece as the word before it.
    """

    def __init__(self, block):
        self.data = ASCII_LOWER[block.data]
        words = split_words(self.data, block.bounds, BREAKS)
        self.starts, self.ends = words.starts, words.ends
        self.rows = block.rows
        self.row = owners(words.bounds)
        ended = np.concatenate([[0], np.cumsum(PIECE_ENDS[self.data], dtype=np.int32)])
        self.follows = np.zeros(len(self.starts), bool)
        self.follows[1:] = (ended[self.starts[1:]] == ended[self.ends[:-1]]) & (self.row[1:] == self.row[:-1])
        self.names = np.empty(len(self.starts), np.uint64)
        first = 0
        while first < len(self.starts):  # hashing takes many bytes a byte, so it goes through the words in steps
            at = self.starts[first]
            last = max(first + 1, int(np.searchsorted(self.ends, at + HASH_BYTES, "right")))
            data = self.data[at : self.ends[last - 1]]
            self.names[first:last] = span_hashes(data, self.starts[first:last] - at, self.ends[first:last] - at)
            first = last

    def of_rows(self, column: str) -> np.ndarray:
        """A whole-number column of the words' documents, as unsigned names."""
        return np.asarray(self.rows.column(column))[self.row].astype(np.int64).view(np.uint64)

    def phrases(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Names of the phrases of ``length`` words from each word on, and which of these exist."""
        count = max(0, len(self.names) - length + 1)
        names, whole = self.names[:count], np.ones(count, bool)
        for i in range(1, length):
            names = pair(names, self.names[i : i + count])
            whole &= self.follows[i : i + count]
        return names, whole

    def texts(self, first: np.ndarray, length: int) -> pa.Array:
        """The phrases of ``length`` words from the words ``first`` on, joined by one space."""
        at = first[:, None] + np.arange(length)
        sizes = self.ends[at] - self.starts[at] + (np.arange(length) < length - 1)
        starts, sizes = self.starts[at].ravel(), sizes.ravel()
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        out = self.data[np.minimum(np.repeat(starts - bounds[:-1], sizes) + np.arange(bounds[-1]), len(self.data) - 1)]
        spaces = (bounds[1:] - 1).reshape(-1, length)[:, :-1].ravel()
        out[spaces] = 0x20
        ends = bounds[::length].astype(np.int64)
        return pa.Array.from_buffers(pa.large_utf8(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _bit(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a name stands in a filter: the number of its word of 64 bits, and the bit."""
    return (names >> np.uint64(70 - FILTER_BITS)).astype(np.int64), (names >> np.uint64(64 - FILTER_BITS)) & np.uint64(63)


def _passes(names: np.ndarray, bits: np.ndarray) -> np.ndarray:
    word, bit = _bit(names)
    return (bits[word] >> bit) & np.uint64(1) > 0


def _filter(names: DataFrame, name) -> np.ndarray:
    """A bitmap of ``FILTER_BITS`` bits in which the bits of all names are set: at most 2 ** (FILTER_BITS - 6) rows are collected."""
    word = F.shiftrightunsigned(name, 70 - FILTER_BITS).alias("word")
    bit = F.shiftrightunsigned(name, 64 - FILTER_BITS).bitwiseAND(63).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = names.groupBy(word).agg(F.bit_or(mask).alias("mask")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[np.asarray(words.column("word"))] = np.asarray(words.column("mask")).view(np.uint64)
    return bits


class Tally:
    """Counts of names by shard, added up until they are too many to hold."""

    def __init__(self):
        self.held = defaultdict(list)
        self.size = 0

    def add(self, place: tuple[int, int], names: np.ndarray) -> None:
        names, n = np.unique(names, return_counts=True)
        self.held[place].append((names, n))
        self.size += len(names)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for (slot, lang_id), parts in self.held.items():
            names, n = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(names)
            names = names[order]
            first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
            names, n = names[first].view(np.int64), np.add.reduceat(n[order], first)
            for a in range(0, len(names), BATCH_ROWS):
                some = names[a : a + BATCH_ROWS]
                columns = [np.full(len(some), slot), np.full(len(some), lang_id), some, n[a : a + BATCH_ROWS]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["slot", "lang_id", "gram", "n"])
        self.held.clear()
        self.size = 0


def _mined(lengths: range, known: int, bits: np.ndarray | None):
    """Counts by shard of the phrases of ``lengths`` words whose parts of ``known`` words all pass the filter ``bits``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for block in blocks(batches, size=TEXT_BYTES):
            passage = Passage(block)
            slots, languages = passage.of_rows("slot"), passage.of_rows("lang_id")
            passing = None
            if known:
                parts, _ = passage.phrases(known)
                passing = _passes(parts ^ languages[: len(parts)] ^ slots[: len(parts)], bits)
            for length in lengths:
                names, whole = passage.phrases(length)
                for i in range(length - known + 1 if known else 0):
                    whole &= passing[i : i + len(names)]
                at = np.flatnonzero(whole)
                order = at[np.argsort(slots[at], kind="stable")]
                for some in np.split(order, np.flatnonzero(np.diff(slots[order])) + 1):
                    if len(some):
                        place = tuple(int(x[some[0]].view(np.int64)) for x in (slots, languages))
                        tally.add(place, names[some] ^ languages[some])
            if tally.size > MOST_COUNTS:
                yield from tally.rows()
        yield from tally.rows()

    return task


def _counted(longest: int, candidates: np.ndarray):
    """Occurrences of all phrases that pass the filter of the candidates, by text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, size=TEXT_BYTES):
            passage = Passage(block)
            languages = passage.of_rows("lang_id")
            for length in range(1, longest + 1):
                names, whole = passage.phrases(length)
                names = names ^ languages[: len(names)]
                at = np.flatnonzero(whole & _passes(names, candidates))
                if not len(at):
                    continue
                # names may be shared, so a phrase is known by its text; a name's first place and its texts' number of places
                _, first, n = np.unique(names[at], return_index=True, return_counts=True)
                lead = at[first]
                lone = _same_words(passage, at, names, lead, length)
                if not lone:
                    lead, n = at, np.ones(len(at), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        passage.rows.column("lang").take(pa.array(passage.row[lead])),
                        passage.texts(lead, length).cast(pa.string()),
                        pa.array(np.full(len(lead), length, np.int32)),
                        pa.array(n.astype(np.int64)),
                    ],
                    ["lang", "phrase", "words", "n"],
                )

    return task


def _same_words(passage: Passage, at: np.ndarray, names: np.ndarray, lead: np.ndarray, length: int) -> bool:
    """Whether places of one name hold words of the same names and sizes as the first of them."""
    first = lead[np.searchsorted(names[lead], names[at])]
    sizes = passage.ends - passage.starts
    return all(
        (passage.names[at + i] == passage.names[first + i]).all() and (sizes[at + i] == sizes[first + i]).all()
        for i in range(length)
    )


def frequent_phrases(docs: DataFrame, least: int, longest: int, staging: Staging) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases of up to ``longest`` words that their language holds ``least`` times,
    and (lang, n) with all words of each language."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    shard = F.pmod(F.spark_partition_id(), F.lit(SHARDS))  # written down, so that a document's shard stays what it is
    texts = docs.select(lang.alias("lang"), "text", shard.alias("shard")).where("text IS NOT NULL")
    names = {"lang_id": F.xxhash64("lang"), "slot": F.xxhash64("lang", "shard")}
    texts = staging.write(texts.withColumns(names).drop("shard"), "texts")

    sizes, shares, known, bits, mined = None, None, 0, None, []
    for lengths in (range(1, 2), range(2, 3), range(3, longest + 1)):
        if lengths.start > longest:
            break
        counts = texts.select("text", "slot", "lang_id").mapInArrow(_mined(lengths, known, bits), MINED)
        counts = counts.groupBy("slot", "lang_id", "gram").agg(F.sum("n").alias("n"))
        if not known:
            counts = staging.write(counts, "words")
            sizes = counts.groupBy("slot", "lang_id").agg(F.sum("n").alias("m"))
            whole = sizes.groupBy("lang_id").agg(F.sum("m").alias("all"))
            share = F.expr(f"cast((cast({least} as decimal(20,0)) * m + all - 1) div all as long)").alias("support")
            shares = staging.write(sizes.join(whole, "lang_id").select("slot", share), "shares")
        frequent = counts.join(sized(shares, 48), "slot").where(F.col("n") >= F.col("support"))
        frequent = staging.write(frequent.select("slot", "lang_id", "gram"), f"mined{lengths.start}")
        mined.append(frequent.select("gram"))
        known = lengths.start
        if known < min(longest, 3):
            bits = _filter(frequent, F.col("gram").bitwiseXOR(F.col("slot")))
    union = mined[0]
    for more in mined[1:]:
        union = union.unionByName(more)
    candidates = _filter(union, F.col("gram"))
    found = texts.select("text", "lang", "lang_id").mapInArrow(
        _counted(longest, candidates), "lang string, phrase string, words int, n long"
    )
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    languages = texts.select("lang", "lang_id").distinct()
    totals = sizes.groupBy("lang_id").agg(F.sum("m").alias("n")).join(languages, "lang_id").select("lang", "n")
    return staging.write(found, "phrases"), staging.write(totals, "totals")


def _part(first, length):
    return F.array_join(F.slice("w", first, length), " ")


def _cuts(phrases: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score: each phrase of two words or more, cut where it holds together least."""
    several = phrases.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    k = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = several.select("lang", "phrase", "words", "a", "w", k)
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("left"), _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"))
    counts = phrases.select("lang", F.col("phrase").alias("part"), "n")
    cuts = cuts.join(counts.withColumnsRenamed({"part": "left", "n": "l"}), ["lang", "left"])
    cuts = cuts.join(counts.withColumnsRenamed({"part": "right", "n": "r"}), ["lang", "right"])
    score = F.expr("(cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + r)")
    worst = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _within_longer(phrases: DataFrame, longest: int) -> DataFrame:
    """lang, phrase, longer: the largest count of a longer candidate that holds the phrase's words in a row."""
    long = phrases.where("words > 2").select("lang", "words", "n", F.split("phrase", " ").alias("w"))
    spans = [(first, size) for size in range(2, longest) for first in range(1, longest - size + 2)]
    parts = [F.when((first + size - 1 <= F.col("words")) & (size < F.col("words")), _part(first, size)) for first, size in spans]
    parts = long.select("lang", "n", F.explode(F.array_compact(F.array(*parts))).alias("phrase"))
    return parts.groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, subsumed: int = 80, most: int = 2000) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: each language's ``most`` phrases that hold together best.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and these into words at spaces and
    tabs. Phrases are 2 to ``longest`` words of one piece in a row; ``a`` counts all of a phrase's places, overlaps
    included, and is ``least`` or more. Cut after k words, the first part has ``l`` and the rest ``r`` places, and the
    score is ``floor(2000000 * a / (l + r))`` at the cut where that is lowest (the first of equal ones); ``n`` counts
    the language's words. A phrase that stands within a longer one with ``subsumed`` per cent of its count or more is
    left out. Ties in score go to the larger ``a``, then to the smaller phrase in byte order.

    ``docs`` has text and lang; other columns are ignored. A null lang counts as ``und``; null and empty texts have
    no words; repeated rows count as often as they stand there; an empty table gives an empty result. A text of any
    length is read whole, in memory of about 30 bytes a byte of the longest one.
    """
    staging = Staging(docs.sparkSession, "collocations")
    phrases, totals = frequent_phrases(docs, least, longest, staging)
    scored = _cuts(phrases).join(_within_longer(phrases, longest), ["lang", "phrase"], "left")
    held = F.expr(f"cast(100 as decimal(18,0)) * longer >= cast({subsumed} as decimal(18,0)) * a")
    kept = scored.where(~F.coalesce(held, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    ranked = ranked.join(sized(totals, 32 + F.octet_length("lang")), "lang")
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
