"""Benchmark decontamination over a positional inverted index, in DataFrame operations only.

Documents are tokenised once. The index holds a posting (document, position, term) for each word that
some benchmark item uses, and one end mark for each document, whose position is its number of
words. Everything after that reads the index:

1. term counts over the whole corpus give the two rarest terms of every window of an item;
2. the list of the rarest term, shifted by the term's offset in the item, gives alignments
   (document, item, shift), which are intersected with the shifted list of the second rarest;
3. what is left is intersected with the lists of all of the item's words; unbroken runs of at least a
   window's length are the exact phrase matches.

No list is shuffled by term: the benchmark's side is broadcast while its size allows it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.shared import Staging, keyed, sized

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
END = ""
ROW = ["doc", "key"]


def words(text: str) -> Column:
    """Lower-cased (A-Z) runs of digits, letters and characters beyond ASCII; none for null."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BREAK), "")


@dataclass
class Index:
    """``postings``: doc, key, pos, term. ``ends``: doc, key, n_words. ``items``: item, item_id, size, ipos, term, n."""

    postings: DataFrame
    ends: DataFrame
    items: DataFrame
    staging: Staging


def build_index(docs: DataFrame, benchmark: DataFrame, staging: Staging) -> Index:
    """The positional index of ``docs`` for the words of ``benchmark`` (item_id, text)."""
    texts = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text")).distinct()
    texts = texts.select(F.xxhash64("item_id", "text").alias("item"), "item_id", words("text").alias("w"))
    terms = texts.select("item", "item_id", F.size("w").alias("size"), F.posexplode("w").alias("ipos", "term"))
    terms = staging.write(terms, "terms")
    end = docs.sparkSession.range(1).select(F.lit(END).alias("term"))
    vocabulary = staging.write(terms.select("term").distinct().unionByName(end), "vocabulary")

    tokens = docs.select(*ROW, F.posexplode(F.concat(words("text"), F.array(F.lit(END)))).alias("pos", "term"))
    index = staging.write(tokens.join(sized(vocabulary, 64 + F.octet_length("term")), "term"), "postings")
    postings = index.where(F.col("term") != END)
    counts = staging.write(postings.groupBy("term").agg(F.count("*").alias("n")), "counts")
    items = staging.write(terms.join(counts, "term"), "items")  # a term that no document has matches nothing
    ends = index.where(F.col("term") == END).select(*ROW, F.col("pos").cast("long").alias("n_words"))
    return Index(postings, ends, items, staging)


def _probes(items: DataFrame, window: int) -> DataFrame:
    """item, and the offsets and terms of the two rarest words of each of its windows."""
    ahead = Window.partitionBy("item").orderBy("ipos").rowsBetween(0, window - 1)
    width = F.least(F.lit(window), F.col("size"))
    windows = items.select(
        "item", "ipos", "size", F.sort_array(F.collect_list(F.struct("n", "ipos", "term")).over(ahead)).alias("rarest")
    )
    windows = windows.where((F.size("rarest") == width) & (F.col("ipos") + width <= F.col("size")))
    # where a term that no document has is left out, the next words are further ahead
    windows = windows.where(F.array_max(F.transform("rarest", lambda r: r["ipos"])) < F.col("ipos") + width)
    first, second = F.col("rarest")[0], F.get("rarest", F.lit(1))
    probes = windows.select(
        "item",
        first["ipos"].alias("at"),
        first["term"].alias("term"),
        F.coalesce(second["ipos"], first["ipos"]).alias("at2"),
        F.coalesce(second["term"], first["term"]).alias("term2"),
    )
    return probes.distinct()


def phrase_matches(index: Index, window: int) -> DataFrame:
    """doc, key, item_id, low, high: the positions that whole windows of an item cover, one run a row."""
    staging, postings = index.staging, index.postings
    probes = staging.write(_probes(index.items, window), "probes")
    size = 96 + F.octet_length("term") + F.octet_length("term2")
    found = postings.join(sized(probes, size), "term").select(
        *ROW,
        "item",
        (F.col("pos") - F.col("at")).alias("shift"),
        (F.col("pos") - F.col("at") + F.col("at2")).alias("pos"),
        F.col("term2").alias("term"),
    )
    found = staging.write(found.distinct(), "rarest")  # a shift below 0: the document begins within the item
    second = staging.write(probes.select(F.col("term2").alias("term")).distinct(), "second")
    lists = postings.join(sized(second, 64 + F.octet_length("term")), "term")
    found = found.join(lists, [*ROW, "pos", "term"], "left_semi").select(*ROW, "item", "shift").distinct()
    found = staging.write(found, "alignments")

    some = staging.write(found.select(*ROW).distinct(), "some")
    lists = postings.join(sized(some, 48), ROW)
    items = staging.write(index.items.select("item", "item_id", "size", "ipos", "term"), "words")
    wanted = found.join(sized(items, 96 + F.octet_length("term")), "item")
    wanted = wanted.withColumn("pos", F.col("shift") + F.col("ipos"))
    alignment = [*ROW, "item", "item_id", "size", "shift"]
    matched = wanted.join(lists, [*ROW, "pos", "term"], "left_semi").select(*alignment, "ipos")
    before = Window.partitionBy(*ROW, "item", "shift").orderBy("ipos")
    runs = matched.withColumn("run", F.col("ipos") - F.row_number().over(before))
    runs = runs.groupBy(*alignment, "run").agg(F.min("ipos").alias("a"), F.max("ipos").alias("b"))
    runs = runs.where(F.col("b") - F.col("a") + 1 >= F.least(F.lit(window), F.col("size")))
    return runs.select(*ROW, "item_id", (F.col("shift") + F.col("a")).alias("low"), (F.col("shift") + F.col("b")).alias("high"))


def proximity_matches(index: Index, rarest: int = 3, within: int = 20) -> DataFrame:
    """doc, key, item_id, span: documents that hold an item's ``rarest`` rarest terms close together.

    ``span`` is the smallest number of words, ``within`` at most, from an occurrence of the rarest
    term that holds an occurrence of each of the others. Items with a term that no document has, or
    with fewer distinct terms than ``rarest``, match nothing.
    """
    distinct = index.items.groupBy("item", "item_id", "term").agg(F.min("n").alias("n"))
    by_rarity = Window.partitionBy("item").orderBy("n", "term")
    ranked = distinct.withColumn("rank", F.row_number().over(by_rarity)).where(F.col("rank") <= rarest)
    ranked = index.staging.write(ranked.select("item", "item_id", "term", "rank"), "ranked")
    hits = index.postings.join(sized(ranked, 128), "term")
    spans = hits.where("rank = 1").select(*ROW, "item", "item_id", "pos", F.col("pos").alias("low"), F.col("pos").alias("high"))
    for rank in range(2, rarest + 1):
        other = hits.where(F.col("rank") == rank).select(*ROW, "item", F.col("pos").alias("p"))
        spans = spans.join(other, [*ROW, "item"]).where(F.abs(F.col("p") - F.col("pos")) < within)
        spans = spans.select(*ROW, "item", "item_id", "pos", F.least("low", "p").alias("low"), F.greatest("high", "p").alias("high"))
        spans = spans.where(F.col("high") - F.col("low") < within).distinct()
    return spans.groupBy(*ROW, "item_id").agg(F.min(F.col("high") - F.col("low") + 1).alias("span"))


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, one_in: int) -> DataFrame:
    """``doc``, ``key``, n_words, n_hit, ``ids`` (null if none) and contaminated, for each row of ``docs``."""
    index = build_index(docs, benchmark, Staging(docs.sparkSession, "decontaminate"))
    matches = index.staging.write(phrase_matches(index, window), "matches")
    hit = matches.select(*ROW, F.explode(F.sequence("low", "high")).alias("pos")).distinct()
    hit = hit.groupBy(*ROW).agg(F.count("*").alias("n_hit"))
    ids = F.sort_array(F.collect_set(F.coalesce("item_id", F.lit(""))))
    hit = index.staging.write(hit.join(matches.groupBy(*ROW).agg(ids.alias("ids")), ROW), "hit")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    out = index.ends.join(sized(hit, 256), ROW, "left").withColumn("n_hit", n_hit)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20) -> DataFrame:
    """For each row: doc_id, n_words, n_hit, n_items, items_sha256 and contaminated.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A document's word is hit if it lies in an occurrence of a window. ``n_items`` counts the
    item ids with occurring windows; the hash is of these ids, sorted as strings and joined by commas.
    A document is contaminated if one in ``one_in`` of its words, or more, is hit, and at least one.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). A null text has no words. Null
    and repeated ids are allowed on both sides; a null item_id counts as one id and is written as
    nothing. Without items, or in an empty table, nothing is hit.
    """
    judged = _judged(keyed(docs, "doc_id", "text"), benchmark, window, one_in)
    return judged.select(
        F.nullif("doc", F.lit((1 << 63) - 1)).alias("doc_id"),
        "n_words",
        "n_hit",
        F.when(F.col("ids").isNull(), 0).otherwise(F.size("ids")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "ids"), F.lit("")), 256).alias("items_sha256"),
        "contaminated",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 13, one_in: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    judged = _judged(keyed(docs, "doc_id", "text"), benchmark, window, one_in)
    staging = Staging(docs.sparkSession, "clean")
    bad = staging.write(judged.where("contaminated").select(*ROW).distinct(), "bad")
    bad = sized(bad.select(F.col("doc").alias("bad_doc"), F.col("key").alias("bad_key")), 48)
    own = [F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)), F.xxhash64("doc_id", "text")]
    return docs.join(bad, (own[0] == F.col("bad_doc")) & (own[1] == F.col("bad_key")), "left_anti")
