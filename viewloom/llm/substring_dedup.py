"""Passages repeated across documents: seeds, extended both ways, kept over a length threshold.

Seeds are winnowed anchors: of every window of ``window`` words, the ``seed`` words with the smallest
hash. Nothing is joined on a seed: it places its windows, which are
grouped by the hash of the core they share (as in ``suffix_dedup``). A seed's match is extended to the left and to the right at
once: places that agree in the whole stretch around the seed are matched as one group, places that
agree only near it are told apart offset by offset (``repeats``), so that the ends of each match
come out to the word. What the matches of at least ``window`` words cover is a maximal repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewloom.llm.repeats import Shape, pairs_by_row, region_mask, repeated_windows, with_regions
from viewloom.llm.shared import Staging, keyed
from viewloom.llm.text import Block, blocks, span_hashes, split_words

SEED_WORDS = 8
RESULT = "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"


def shape_for(window: int) -> Shape:
    if window < 2:
        raise ValueError("a window has two words at least")
    seed = min(SEED_WORDS, window)
    step = 16
    while step > max(1, window // 3):
        step //= 2
    return Shape(window, seed, (step, 1) if step > 1 else (1,))


def _words(block: Block):
    words = split_words(block.data, block.bounds)
    hashes = span_hashes(block.data, words.starts, words.ends)
    return hashes, words.bounds, lambda a, b: hashes[a:b].tobytes()


def _expand(data: np.ndarray) -> np.ndarray:
    return data.copy().view(np.uint64)


def _cut(with_text: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            words = split_words(block.data, block.bounds)
            regions = pairs_by_row(block.rows.column("regions"), "start", "end")
            gone = region_mask(words.bounds, regions)
            data = block.data.tobytes()
            sizes, removed, kept = np.diff(words.bounds), [], []
            for a, b in zip(words.bounds[:-1], words.bounds[1:]):
                stay = np.flatnonzero(~gone[a:b]) + a
                removed.append(b - a - len(stay))
                kept.append(b" ".join([data[x:y] for x, y in zip(words.starts[stay].tolist(), words.ends[stay].tolist())]))
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()) if with_text else pa.nulls(len(kept), pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                ],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return task


def remove_repeated_passages(docs: DataFrame, window: int = 50, with_text: bool = True) -> DataFrame:
    """Each document without the words of passages that a document with a smaller id holds too.

    A passage is ``window`` consecutive words (runs of characters other than space and ``\\t`` to
    ``\\r``, unchanged). Columns: doc_id, n_words, n_removed, kept (the words left, joined by one
    space; null unless ``with_text``) and kept_sha256 of its UTF-8.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). A null or empty text has no
    words. A null id counts as larger than all others. Rows of the same id never remove each other's
    words, repeated rows get the same result, and an empty table gives an empty result.
    """
    docs = keyed(docs, "doc_id", "text")
    staging = Staging(docs.sparkSession, "substring-dedup")
    regions = repeated_windows(docs, shape_for(window), _words, 8, _expand, True, staging)
    return with_regions(docs, regions).select("doc_id", "text", "regions").mapInArrow(_cut(with_text), RESULT)
