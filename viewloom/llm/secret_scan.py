"""Secrets in texts and in what texts encode, by a worklist of decoded layers.

Every layer is scanned for secrets and for encodings. Percent escapes (with plus signs as spaces too), backslash escapes
and ASCII in 16 bits are unwrapped in the whole layer, so what stands around them stays context; runs of base64, joined
over line breaks, are decoded from each of their first four characters, as a run may begin with what is not base64. All
that this gives, text or not, is scanned a character a byte (secrets and encodings are ASCII), and so is what data within
unpacks to (gzip, zlib, bz2, xz), whatever it was unwrapped from, again and again. Layers seen before for the same place are skipped, which ends cycles. Each character of a layer knows the
stretch of the original text it comes from, so that a secret found in any layer has a span there.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
# runs of one class of characters, so asking for the length here finds the same runs as dropping short ones
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGNED = 8

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(
    r"\\u\{([0-9A-Fa-f]{1,6})\}|[\\%]u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|\\([nrtbf0'\"/\\])"
)
LETTERS = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f", "0": "\0"}
_ASCII = "[\t\n\r\x20-\x7e]"
WIDE = re.compile(f"(?:{_ASCII}\0){{4,}}|(?:\0{_ASCII}){{4,}}")
DIGITS = "A-Za-z0-9+/_-"
BASE64 = re.compile(
    rf"(?<![{DIGITS}])(?:[{DIGITS}]{{16,}}+|[{DIGITS}]++(?=[ \t]*+[\r\n]))(?:[ \t]*+[\r\n][ \t\r\n]*+[{DIGITS}]++)*+"
)
LEAST_DIGITS = 16
_STANDARD = bytes.maketrans(b"-_", b"+/")
# zlib: deflate with a window of any size, no dictionary; the two bytes are a multiple of 31
_ZLIB = [bytes([size << 4 | 8, x]) for size in range(8) for x in range(256) if not x & 32 and (size << 12 | 8 << 8 | x) % 31 == 0]
PACKED = re.compile(rb"\x1f\x8b\x08|BZh[1-9]|\xfd7zXZ\x00|" + b"|".join(map(re.escape, _ZLIB)))
_BYTES = re.compile("[\0-\xff]+")
#: Unpacked data is scanned in windows of so many bytes, which overlap ...
WINDOW = 1 << 20
OVERLAP = 1 << 16
#: ... and grow up to so many while a base64 run goes on at their end.
MOST_HELD = 16 << 20
_OPEN_RUN = re.compile(rb"[A-Za-z0-9+/_\- \t\r\n-]*\Z")

FINDINGS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def scan(text: str) -> Iterator[tuple[int, int, int]]:
    """(number of the kind, start, end) of each secret written plainly in ``text``."""
    if ":" in text or "=" in text:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST_ASSIGNED:
                yield 0, m.start(), m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield 1, m.start(), m.end()
    for m in HEX.finditer(text):
        yield 2, m.start(), m.end()


class Layer:
    """A decoded text; character i comes from the original's ``starts[i]:ends[i]``."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray):
        self.text, self.starts, self.ends = text, starts, ends

    def span(self, a: int, b: int) -> tuple[int, int]:
        return int(self.starts[a:b].min()), int(self.ends[a:b].max())

    def replaced(self, pieces: list[tuple[int, int, str, list[tuple[int, int]]]]) -> Layer:
        """With ``[a, b)`` replaced by a text whose characters come from the given parts of the layer."""
        out, starts, ends, at = [], [], [], 0
        for a, b, text, parts in pieces:
            out += [self.text[at:a], text]
            starts += [self.starts[at:a], np.array([self.starts[x] for x, _ in parts], np.int64)]
            ends += [self.ends[at:a], np.array([self.ends[y - 1] for _, y in parts], np.int64)]
            at = b
        out.append(self.text[at:])
        return Layer("".join(out), np.concatenate([*starts, self.starts[at:]]), np.concatenate([*ends, self.ends[at:]]))


def _characters(data: bytes) -> tuple[str, list[int]]:
    """UTF-8 text, or else a character a byte, and the first byte of each, with the length at the end."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return data.decode("latin-1"), list(range(len(data) + 1))
    first = [i for i, b in enumerate(data) if b & 0xC0 != 0x80]
    return text, [*first, len(data)]


def _unpercented(layer: Layer, raw: bool = False) -> Layer | None:
    """Percent escapes as the characters that they encode, or (``raw``) as a character a byte."""
    pieces = []
    for m in PERCENT.finditer(layer.text):
        data = bytes.fromhex(m[0].replace("%", ""))
        text, at = (data.decode("latin-1"), range(len(data) + 1)) if raw else _characters(data)
        parts = [(m.start() + 3 * at[i], m.start() + 3 * at[i + 1]) for i in range(len(text))]
        pieces.append((m.start(), m.end(), text, parts))
    return layer.replaced(pieces) if pieces else None


def _spaced(layer: Layer) -> Layer | None:
    """Plus signs as spaces, as forms write them beside percent escapes."""
    if "+" not in layer.text or not PERCENT.search(layer.text):
        return None
    return Layer(layer.text.replace("+", " "), layer.starts, layer.ends)


def _unescaped(layer: Layer) -> Layer | None:
    pieces, high = [], None
    for m in ESCAPE.finditer(layer.text):
        if m[5]:
            pieces.append((m.start(), m.end(), LETTERS.get(m[5], m[5]), [(m.start(), m.end())]))
            continue
        point = int(next(g for g in m.groups() if g), 16)
        if high and high[1] == m.start() and 0xDC00 <= point < 0xE000:  # the other half of a pair
            point = 0x10000 + (high[2] - 0xD800) * 0x400 + point - 0xDC00
            pieces.append((high[0], m.end(), chr(point), [(high[0], m.end())]))
            high = None
            continue
        high = (m.start(), m.end(), point) if 0xD800 <= point < 0xDC00 else None
        if point < 0x110000 and not 0xD800 <= point < 0xE000:
            pieces.append((m.start(), m.end(), chr(point), [(m.start(), m.end())]))
    return layer.replaced(pieces) if pieces else None


def _narrowed(layer: Layer) -> Layer | None:
    """ASCII in 16 bits (either byte order) as ASCII."""
    if "\0" not in layer.text:
        return None
    pieces = []
    for m in WIDE.finditer(layer.text):
        parts = [(i, i + 2) for i in range(m.start(), m.end(), 2)]
        pieces.append((m.start(), m.end(), m[0].replace("\0", ""), parts))
    return layer.replaced(pieces) if pieces else None


def _unpacked_in(layer: Layer) -> Iterator[Layer]:
    """What packed data among the layer's characters unpacks to, a character a byte."""
    for m in _BYTES.finditer(layer.text):
        data = m[0].encode("latin-1")
        if PACKED.search(data):
            a, b = layer.span(m.start(), m.end())
            for window in _unpacked(data):
                text = window.decode("latin-1")
                if _worth(text):
                    yield Layer(text, np.broadcast_to(a, len(text)), np.broadcast_to(b, len(text)))


def _decompressor(head: bytes):
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=128 << 20)
    return zlib.decompressobj()


def _streamed(source: Iterator[bytes]) -> Iterator[bytes]:
    """What packed data, given in pieces, unpacks to: all members that follow each other, up to a defect."""
    rest = b""
    while True:
        while len(rest) < 8 and (more := next(source, None)) is not None:
            rest += more
        rest = rest.lstrip(b"\0")  # padding between members
        if not PACKED.match(rest):
            return
        unpacker = _decompressor(rest)
        inflates = not isinstance(unpacker, (bz2.BZ2Decompressor, lzma.LZMADecompressor))
        try:
            while not unpacker.eof:
                if inflates:
                    out, rest = unpacker.decompress(rest, WINDOW), unpacker.unconsumed_tail
                else:
                    out, rest = unpacker.decompress(rest, WINDOW), b""
                if out:
                    yield out
                if not unpacker.eof and not rest and (inflates or unpacker.needs_input):
                    if (more := next(source, None)) is not None:
                        rest = more
                    elif not out:
                        return
        except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
            return
        rest = unpacker.unused_data + (rest if inflates and not unpacker.unused_data else b"")


def _windows(pieces: Iterator[bytes]) -> Iterator[bytes]:
    """Overlapping windows of a stream; none ends within a base64 run that it can hold."""
    held, new = b"", 0
    for piece in pieces:
        held += piece
        new += len(piece)
        if new < WINDOW:
            continue
        if len(held) < MOST_HELD and len(held) - _open_run(held) > OVERLAP // 2:
            continue
        yield held
        held, new = held[-OVERLAP:], 0
    if new:
        yield held


def _open_run(held: bytes) -> int:
    """Where the base64 run at the end begins."""
    last = len(held)
    while last:  # piece by piece from the end, as the run is short in general
        first = max(0, last - 4096)
        at = first + _OPEN_RUN.search(held[first:last]).start()
        if at > first:
            return at
        last = first
    return 0


def _pieces(data: bytes, at: int) -> Iterator[bytes]:
    return (data[i : i + OVERLAP] for i in range(at, len(data), OVERLAP))


def _from(source, at: int) -> Iterator[bytes]:
    """The stream that ``source()`` gives, from byte ``at`` on."""
    for piece in source():
        if at < len(piece):
            yield piece[at:]
        at = max(0, at - len(piece))


def _unpacked(data: bytes) -> Iterator[bytes]:
    """Windows of all that packed data anywhere in ``data`` unpacks to, and of what that unpacks to in turn.

    Sources are kept as ways to make their pieces, so that packed data inside large unpacked data is
    unpacked again from its place, whatever its size, without holding what comes before it.
    """
    seen = set()
    todo = [lambda at=m.start(): _pieces(data, at) for m in PACKED.finditer(data)]
    while todo:
        source = todo.pop()
        stream = _streamed(source())
        first = b""
        while len(first) < WINDOW and (piece := next(stream, None)) is not None:
            first += piece
        mark = hashlib.blake2b(first, digest_size=16).digest()
        if mark in seen:  # data that unpacks to itself
            continue
        seen.add(mark)
        if len(first) < WINDOW:
            yield first
            todo += [lambda first=first, at=m.start(): _pieces(first, at) for m in PACKED.finditer(first)]
            continue
        unpacked = lambda source=source: _streamed(source())
        done, nested = 0, set()
        for window in _windows(_counted(chain([first], stream), counter := [0])):
            start = counter[0] - len(window)
            yield window
            for m in PACKED.finditer(window, max(0, done - start)):
                if start + m.start() not in nested:
                    nested.add(start + m.start())
                    todo.append(lambda unpacked=unpacked, at=start + m.start(): _from(unpacked, at))
            done = max(done, counter[0] - 8)  # a mark cut at the end is whole in the next window


def _counted(pieces: Iterator[bytes], counter: list[int]) -> Iterator[bytes]:
    for piece in pieces:
        counter[0] += len(piece)
        yield piece


def _worth(text: str) -> bool:
    return (
        next(scan(text), None) is not None
        or ("%" in text and PERCENT.search(text) is not None)
        or (("\\" in text or "%u" in text) and ESCAPE.search(text) is not None)
        or ("\0" in text and WIDE.search(text) is not None)
        or BASE64.search(text) is not None
    )


def _unbased(layer: Layer) -> Iterator[Layer]:
    for m in BASE64.finditer(layer.text):
        if len(m[0]) < LEAST_DIGITS:
            continue
        run = np.frombuffer(m[0].encode("ascii"), np.uint8)
        place = np.flatnonzero(run > 32)  # line breaks are no digits
        if len(place) < LEAST_DIGITS:
            continue
        digits, place = run[place].tobytes().translate(_STANDARD), place + m.start()
        a, b = layer.span(m.start(), m.end())
        for first in range(4):
            some = digits[first:]
            if len(some) % 4 == 1:
                some = some[:-1]
            data = binascii.a2b_base64(some + b"=" * (-len(some) % 4))
            text = data.decode("latin-1")
            if _worth(text):
                at = np.arange(len(data) + 1)
                begin, end = first + at[:-1] * 4 // 3, first + np.minimum(-(-at[1:] * 4 // 3), len(some))
                yield Layer(text, layer.starts[place[begin]], layer.ends[place[end - 1]])
            for window in _unpacked(data):
                text = window.decode("latin-1")
                if _worth(text):
                    yield Layer(text, np.broadcast_to(a, len(text)), np.broadcast_to(b, len(text)))


def _encoded(text: str) -> bool:
    return "%" in text or "\\" in text or BASE64.search(text) is not None


def findings(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, number of the kind, whether written plainly) of all secrets, in order."""
    found = {(start, end, kind): True for kind, start, end in scan(text)}
    if _encoded(text):
        place = np.arange(len(text))
        # layers come one by one, so that few windows of unpacked data are held at a time
        todo, seen = [iter([Layer(text, place, place + 1)])], set()
        while todo:
            layer = next(todo[-1], None)
            if layer is None:
                todo.pop()
                continue
            if not layer.text:
                continue
            digest = hashlib.blake2b(layer.text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            mark = (digest, *layer.span(0, len(layer.text)))
            if mark in seen:
                continue
            seen.add(mark)
            if len(seen) > 1:
                for kind, a, b in scan(layer.text):
                    found.setdefault((*layer.span(a, b), kind), False)
            todo.append(_layers_of(layer))
    return sorted((a, b, kind, base) for (a, b, kind), base in found.items())


def _layers_of(layer: Layer) -> Iterator[Layer]:
    for unwrapped in (_unpercented, _unescaped, _narrowed, _spaced):
        if (found := unwrapped(layer)) is not None:
            yield found
    for raw in (_unpercented(layer, raw=True), _unescaped(layer)):
        if raw is not None:
            yield from _unpacked_in(raw)
    yield from _unbased(layer)


def ordered(found: list[tuple[int, int, int, bool]]) -> list[dict]:
    found = sorted(found, key=lambda x: (x[0], x[2], x[1]))
    return [{"kind": KINDS[kind], "start": a, "end": b, "base": base} for a, b, kind, base in found]


def masked(text: str, found: list[tuple[int, int, int, bool]], mask: str) -> str:
    """``text`` with each maximal stretch of overlapping findings replaced by ``mask``."""
    out, at, i = [], 0, 0
    while i < len(found):
        a, b = found[i][:2]
        while i < len(found) and found[i][0] < max(b, a + 1):
            b = max(b, found[i][1])
            i += 1
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]]) if found else text


def _scanning(rows_at_once: int = 256):
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, rows_at_once):
                rows = batch.slice(first, rows_at_once)
                found = [ordered(findings(t)) if t else [] for t in rows.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id").cast(pa.int64()), pa.array(found, kind)], ["doc_id", "findings"]
                )

    return task


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and findings: kind, start, end (code points, end exclusive) and base, ordered by start, then kind.

    ``base`` findings are written plainly; the others stand in a layer that the text encodes and span what
    encodes them. A finding of both sorts is a base one.

    One row per row of ``docs`` (doc_id, text; other columns are ignored). A null or empty text has no
    findings. Null and repeated ids are allowed; an empty table gives an empty result. A text of any length is read
    whole, in memory of about 25 bytes a byte of it where it holds encodings; what it packs is read in windows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_scanning(), f"doc_id long, findings {FINDINGS}")


def mask_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs``, all columns as they are, with findings in ``text`` replaced by ``mask``; null stays null."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows = batch.slice(first, 256)
                at = rows.schema.get_field_index("text")
                texts = [masked(t, findings(t), mask) if t else t for t in rows.column(at).to_pylist()]
                yield rows.set_column(at, rows.schema.field(at), pa.array(texts, rows.schema.field(at).type))

    return docs.mapInArrow(task, docs.schema)


def count_of(kind: str) -> Column:
    """Base findings of a kind."""
    return F.size(F.filter("findings", lambda x: x["base"] & (x["kind"] == kind))).cast("long")


def spans(base_only: bool) -> Column:
    """Findings as kind:start:end, joined by commas."""
    chosen = F.filter("findings", lambda x: x["base"]) if base_only else F.col("findings")
    written = F.transform(chosen, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(written, ",")
