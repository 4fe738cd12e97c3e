"""Vectorised text kernels: blocks of whole texts as byte arrays, words, and 64-bit mixes.

A block is some consecutive texts of an Arrow batch laid end to end, so that one numpy call works
on many texts. Texts are never cut; a text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_ODD = 0xD6E8FEB86659FD93
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)

ASCII_SPACE = np.zeros(256, bool)
ASCII_SPACE[[0x20, *range(0x09, 0x0E)]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A mix of two identifiers that depends on their order."""
    x = a * _GOLDEN + b * _SECOND
    x = (x ^ (x >> np.uint64(32))) * _MIX1
    return x ^ (x >> np.uint64(29))


@dataclass
class Block:
    """``data`` holds texts end to end; text i is ``data[bounds[i]:bounds[i + 1]]``."""

    rows: pa.RecordBatch
    data: np.ndarray
    bounds: np.ndarray
    valid: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


def blocks(
    batches: Iterator[pa.RecordBatch], column: str = "text", size: int = BLOCK_BYTES, most: int = 1 << 14
) -> Iterator[Block]:
    """The batches' texts as blocks of ``most`` texts at most; a null text has no bytes and is not valid."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = batch.column(column)
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.cast(pa.large_binary())
        valid = np.asarray(texts.is_valid())
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        if texts.null_count:  # a null may still span bytes
            lengths = np.where(valid, np.diff(ends), 0)
            raw = np.concatenate([raw[a : a + n] for a, n in zip(ends[:-1], lengths)])
            ends = np.concatenate([[0], np.cumsum(lengths)])
        first = 0
        while first < len(texts):
            last = int(np.searchsorted(ends, ends[first] + size, "right")) - 1
            last = min(max(last, first + 1), first + most, len(texts))
            yield Block(
                batch.slice(first, last - first),
                raw[ends[first] : ends[last]],
                ends[first : last + 1] - ends[first],
                valid[first:last],
            )
            first = last


@dataclass
class Words:
    """Words of a block: ``data[starts[i]:ends[i]]``; word i of text t has bounds[t] <= i < bounds[t + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray


def split_words(data: np.ndarray, bounds: np.ndarray, separator: np.ndarray = ASCII_SPACE) -> Words:
    """Maximal runs of bytes that are not separators, within each text."""
    inside = ~separator[data]
    edge = np.empty(len(data), bool)
    if len(data):
        edge[0] = inside[0]
        edge[1:] = inside[1:] & ~inside[:-1]
        cuts = bounds[:-1][bounds[:-1] < len(data)]
        edge[cuts] = inside[cuts]
    starts = np.flatnonzero(edge)
    stop = np.empty(len(data), bool)
    if len(data):
        stop[-1] = inside[-1]
        stop[:-1] = inside[:-1] & ~inside[1:]
        cuts = bounds[1:][bounds[1:] > 0] - 1
        stop[cuts] = inside[cuts]
    ends = np.flatnonzero(stop) + 1
    return Words(starts, ends, np.searchsorted(starts, bounds))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes, equal for equal bytes wherever they stand.

    Sums byte values times powers of an odd number up to each position; a span's difference,
    divided by the power at its start, no longer depends on the position.
    """
    n = len(data)
    power = np.full(n + 1, _ODD, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + _GOLDEN) * power[:n], out=sums[1:])
    inverse = np.full(n + 1, _ODD_INVERSE, np.uint64)
    inverse[0] = 1
    np.cumprod(inverse, out=inverse)
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def run_hashes(symbols: np.ndarray, length: int) -> np.ndarray:
    """The identifier of ``symbols[i:i + length]`` for every i where that many symbols follow.

    Identifiers of twice a length come from two identifiers of that length, the second at a later
    offset; the last step overlaps.
    """
    ids, have = symbols, 1
    while have * 2 <= length:
        ids = pair(ids[:-have], ids[have:]) if len(ids) > have else ids[:0]
        have *= 2
    if have < length:
        rest = length - have
        ids = pair(ids[:-rest], ids[rest:]) if len(ids) > rest else ids[:0]
    return ids


def owners(bounds: np.ndarray) -> np.ndarray:
    """For each position, the number of the text that holds it."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def column(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A numpy array as an Arrow column; unsigned identifiers keep their bits."""
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.array(values, kind)


_LETTERS = None


def letters(points: np.ndarray) -> np.ndarray:
    """Code points in lower case where a letter, else a space."""
    global _LETTERS
    if _LETTERS is None:
        table = np.full(1 << 16, 32, np.uint32)
        for i in range(1 << 16):
            lower = chr(i).lower()
            if chr(i).isalpha():
                table[i] = ord(lower) if len(lower) == 1 else i
        _LETTERS = table
    out = _LETTERS[np.minimum(points, 0xFFFF)]
    for point in np.unique(points[points > 0xFFFF]):
        out[points == point] = point if chr(point).isalpha() else 32
    return out


def code_points(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """The block's code points and the bounds of its texts among them."""
    points = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    before = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    return points, before[block.bounds]
