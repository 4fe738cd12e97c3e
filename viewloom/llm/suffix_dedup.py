"""Repeated byte strings, by bucket-pointer refinement of sampled suffixes.

There are no buckets of q-grams: the q-gram only places a suffix's windows, and the first bucket is the
hash of the core that these share, as in ``substring_dedup``. Identifiers are made of what later offsets point at: the
identifier of 2h bytes is made of the identifiers of h bytes at the position and at h bytes after it,
and every refinement reuses those before (``repeats.Ladder``). Identifiers are 64-bit mixes, not
ranks, so the pointer of a later offset is computed where the text is and never fetched, and a bucket
is the group of equal identifiers in one shuffle, in place of one sort of all suffixes.

Only sampled suffixes enter: one q-gram for each window of ``length`` bytes (the one with the smallest
hash), so equal strings are sampled at equal offsets. A bucket of one suffix is settled. A bucket whose
suffixes agree over all windows they stand for is settled. The others are refined, down to single
windows (128, 32, 8 and 1 offsets at a time). Nothing compares pairs, and a bucket of any size is one aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from viewloom.llm.repeats import Shape, pairs_by_row, region_mask, repeated_windows, with_regions
from viewloom.llm.shared import Staging, keyed
from viewloom.llm.text import Block, blocks, mix

Q_GRAM = 16
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def shape_for(length: int) -> Shape:
    if length < 2:
        raise ValueError("a string has two bytes at least")
    steps = [s for s in (128, 32, 8, 1) if s * 3 <= length or s == 1]
    return Shape(length, min(Q_GRAM, length), tuple(steps))


def _expand(data: np.ndarray) -> np.ndarray:
    return mix(data.astype(np.uint64) + np.uint64(257))


def _bytes(block: Block):
    return _expand(block.data), block.bounds, lambda a, b: block.data[a:b].tobytes()


def _cut(with_text: bool):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            regions = pairs_by_row(block.rows.column("regions"), "start", "end")
            stay = ~region_mask(block.bounds, regions)
            kept = [block.data[a:b][stay[a:b]].tobytes() for a, b in zip(block.bounds[:-1], block.bounds[1:])]
            sizes = np.diff(block.bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    block.rows.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sizes - [len(x) for x in kept], pa.int64()),
                    pa.array([len(x) for x in regions], pa.int64()),
                    pa.array(kept, pa.binary()) if with_text else pa.nulls(len(kept), pa.binary()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return task


def remove_repeated_strings(docs: DataFrame, length: int = 400, with_text: bool = True) -> DataFrame:
    """Each document without the bytes covered by a ``length``-byte string that starts elsewhere too.

    Texts are UTF-8 bytes; elsewhere is any other position of any document, the same one included;
    overlaps count and strings are judged on the input. Columns: doc_id, n_bytes, n_removed, n_spans
    (maximal removed runs), kept (bytes left; null unless ``with_text``) and kept_sha256.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). A null text is an empty one.
    Null and repeated ids are allowed, rows that repeat remove each other, and an empty table gives
    an empty result.
    """
    docs = keyed(docs, "doc_id", "text")
    staging = Staging(docs.sparkSession, "suffix-dedup")
    regions = repeated_windows(docs, shape_for(length), _bytes, 1, _expand, False, staging)
    return with_regions(docs, regions).select("doc_id", "text", "regions").mapInArrow(_cut(with_text), RESULT)
