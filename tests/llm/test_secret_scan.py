"""Secrets against a plain scan, round trips through nested encodings, and the defined edge cases."""

import base64
import bz2
import gzip
import json
import lzma
import random
import re
import urllib.parse
import zlib

import pytest

from viewloom.llm.secret_scan import findings, mask_secrets, masked, scan, scan_secrets

SECRET = "api_key = Zx81-secretvalue.99"


def plain(text):
    kinds = [
        (r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
        (r"AKIA[A-Z0-9]+", 0, 16),
        (r"[0-9a-f]+", 0, 32),
    ]
    return sorted(
        (k, m.start(), m.end()) for k, (p, g, n) in enumerate(kinds) for m in re.finditer(p, text) if len(m[g]) >= n
    )


def test_plain_scan_drops_what_is_too_short():
    rng = random.Random(1)
    pieces = ["token", "API_KEY", "secret", ":", "=", " ", '"', "a", "deadbeef", "AKIA", "ABCD1234", "é", "passwd", "\u017fecret", "\u212aey"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))
        assert sorted(scan(text)) == plain(text)


def wrap(kind, data):
    return {
        "percent": lambda: urllib.parse.quote(data, safe=" "),
        "all percent": lambda: "".join(f"%{b:02X}" for b in data.encode()),
        "unicode": lambda: "".join(f"\\u{ord(c):04x}" for c in data),
        "base64": lambda: base64.b64encode(data.encode()).decode(),
        "url base64": lambda: base64.urlsafe_b64encode(data.encode()).decode().rstrip("="),
        "gzip": lambda: base64.b64encode(gzip.compress(data.encode())).decode(),
        "zlib twice": lambda: base64.b64encode(zlib.compress(zlib.compress(data.encode()))).decode(),
        "bz2": lambda: base64.b64encode(bz2.compress(data.encode())).decode(),
    }[kind]()


WRAPS = ["percent", "all percent", "unicode", "base64", "url base64", "gzip", "zlib twice", "bz2"]


@pytest.mark.parametrize("outer", WRAPS)
@pytest.mark.parametrize("inner", WRAPS)
def test_nested_layers_are_found_in_place(inner, outer):
    data = wrap(outer, wrap(inner, f"néar {SECRET} end"))
    text = f"before ü {data} after"
    a, b = text.index(data), text.index(data) + len(data)
    found = [x for x in findings(text) if x[2] == 0 and not x[3]]
    assert found and all(a <= s < e <= b for s, e, *_ in found)
    assert SECRET not in masked(text, findings(text), "[secret]")


def wrap_bytes(kind, data):
    """Layers over bytes; the first are text again, a character a byte, the others are not."""
    packer = zlib.compressobj(9, zlib.DEFLATED, 9)
    text = data.decode("latin-1")
    return {
        "percent": lambda: urllib.parse.quote_from_bytes(data).encode(),
        "form": lambda: urllib.parse.quote_plus(data).encode(),
        "\\u": lambda: "".join(f"\\u{b:04x}" for b in data).encode(),
        "%u": lambda: "".join(f"%u{b:04X}" for b in data).encode(),
        "\\x": lambda: "".join(f"\\x{b:02x}" for b in data).encode(),
        "repr": lambda: repr(data)[2:-1].encode(),
        "json": lambda: json.dumps(text)[1:-1].encode(),
        "base64": lambda: base64.b64encode(data),
        "wrapped base64": lambda: base64.encodebytes(data),
        "utf-16": lambda: text.encode("utf-16-le"),
        "utf-16 be": lambda: text.encode("utf-16-be"),
        "gzip": lambda: gzip.compress(data),
        "zlib of a small window": lambda: packer.compress(data) + packer.flush(),
        "bz2": lambda: bz2.compress(data),
        "xz": lambda: lzma.compress(data),
    }[kind]()


TEXTS = ["percent", "form", "\\u", "%u", "\\x", "repr", "json", "base64", "wrapped base64"]
BINARIES = ["utf-16", "utf-16 be", "gzip", "zlib of a small window", "bz2", "xz"]


@pytest.mark.parametrize("outer", TEXTS)
@pytest.mark.parametrize("inner", TEXTS + BINARIES)
def test_every_pair_of_layers_over_bytes(inner, outer):
    """A text layer around any other, and around any other in packed data."""
    data = b"near " + SECRET.encode() + b" end " + bytes(range(65, 91)) * 2
    for middle in (None, "gzip", "utf-16", "json"):
        wrapped = wrap_bytes(inner, data)
        if middle == "utf-16" and inner in BINARIES:
            continue  # 16 bits a byte of packed data: no encoding of text
        wrapped = wrap_bytes(outer, wrap_bytes(middle, wrapped) if middle else wrapped).decode("ascii")
        text = f"before {wrapped}\nafter"
        found = [x for x in findings(text) if x[2] == 0]
        assert found, middle
        assert all(0 <= a < b <= len(text) for a, b, *_ in found)


def test_plus_signs_of_forms_are_spaces():
    assert hidden("q=password+%3D+abcdefgh12&x=1") == ["password+%3D+abcdefgh12"]


def test_span_of_one_escaped_layer_is_exact():
    text = "x password%3Dabcdefgh12%20y \\u0074oken: abcdefgh99 z"
    spans = {text[a:b] for a, b, kind, base in findings(text) if not base}
    assert spans == {"password%3Dabcdefgh12", "\\u0074oken: abcdefgh99"}


def test_base64_span_covers_what_encodes_the_secret():
    data = base64.b64encode(b"x" * 30 + SECRET.encode() + b" " + b"y" * 30).decode()
    (a, b, *_), = [x for x in findings(data) if not x[3]]
    assert SECRET.encode() in base64.b64decode(data[a // 4 * 4 : -(-b // 4) * 4])
    assert b - a < len(SECRET) * 4 / 3 + 8


def hidden(text):
    return [text[a:b] for a, b, kind, base in findings(text) if kind == 0 and not base]


def test_base64_over_lines_and_after_separators():
    data = f"{'x' * 40} {SECRET} {'y' * 40}".encode()
    for width in (12, 64, 76):
        lines = base64.b64encode(data).decode()
        lines = "\r\n".join(lines[i : i + width] for i in range(0, len(lines), width))
        assert hidden(f"a:\n{lines}\nb") and SECRET not in masked(lines, findings(lines), "")
    packed = base64.encodebytes(gzip.compress(random.Random(3).randbytes(99) + data)).decode()
    assert hidden(f"-----BEGIN X-----\n{packed}-----END X-----")
    for inner in (data, gzip.compress(data)):
        code = base64.b64encode(inner).decode()
        for before in ("https://host/cb/", "id_", "a-", "host/x/", "ab/c_"):
            (found, *_) = hidden(before + code + " after")
            assert found in before + code


def test_bytes_that_are_not_utf8_do_not_hide_a_secret():
    data = b"\xff\xfe " + SECRET.encode() + b" \xe9 " + bytes(range(128, 200))
    assert hidden("x " + base64.b64encode(data).decode())
    assert hidden("x " + base64.b64encode(bz2.compress(data)).decode())
    assert hidden("x " + "".join(f"%{b:02x}" for b in data))


def test_whole_packed_streams_are_scanned():
    secret = f" {SECRET} ".encode()
    pad = b"\xc3\xa9" * 100
    for pack in (gzip.compress, bz2.compress, lzma.compress, zlib.compress):
        assert hidden("x " + base64.b64encode(pack(pad) + pack(secret)).decode())
        assert hidden("x " + base64.b64encode(pack(pack(pad) + pack(secret))).decode())
    far = b"\xc3\xa9 " * (23 << 20) + secret
    assert hidden("x " + base64.b64encode(gzip.compress(far, 1)).decode())
    for shift in (-20, -10, 0):
        cut = b". " * ((1 << 20) // 2 + shift // 2) + secret + b". " * 1000
        assert hidden("x " + base64.b64encode(bz2.compress(cut)).decode())
    inner = base64.b64encode(random.Random(3).randbytes(3 << 18) + secret)
    nested = base64.b64encode(gzip.compress(b"- " * 999_000 + inner)).decode()
    assert hidden(nested)


def test_rows_and_edge_cases(spark):
    schema = "doc_id long, text string, findings string, kind int"
    rows = [
        (1, None, "", 0),
        (2, "", "", 0),
        (None, "TOKEN: abcdefgh", "", 0),
        (4, "é " * 50000 + "AKIA" + "Z" * 12, "", 0),
        (4, "%%% \\u12 %zz ====", "", 0),
        (5, "%5A" * 3 + "a" * 40, "", 0),
    ]
    docs = spark.createDataFrame(rows, schema)
    got = [[tuple(f) for f in r.findings] for r in scan_secrets(docs).collect()]
    assert got == [
        [],
        [],
        [("assign", 0, 15, True)],
        [("access", 100000, 100016, True)],
        [],
        [("hex", 9, 49, True)],
    ]
    masked_rows = mask_secrets(docs)
    assert masked_rows.columns == docs.columns
    assert [r.text for r in masked_rows.collect()][:3] == [None, "", "[secret]"]
    assert scan_secrets(docs.limit(0)).collect() == []


@pytest.mark.parametrize("before", [1000, 1_500_000])
def test_packed_data_inside_packed_data_is_found_at_any_size(before):
    # Inner packed data after a long run of spaces: found whether the outer data unpacks to less or more than 1 MiB.
    key = "AKIA" + "Q7" * 10
    inner = gzip.compress(f"id {key} end".encode())
    text = "blob " + base64.b64encode(gzip.compress(b" " * before + inner + b" " * 1000)).decode()
    found = findings(text)
    assert any(kind == 1 and not base for _, _, kind, base in found)
