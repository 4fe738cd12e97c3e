"""Repeated passages and strings against brute force, and their defined edge cases."""

import hashlib
import random
import re

import numpy as np
import pytest

from viewloom.llm import repeats
from viewloom.llm.substring_dedup import remove_repeated_passages
from viewloom.llm.suffix_dedup import remove_repeated_strings

SCHEMA = "doc_id long, text string"


def brute_passages(docs, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in docs]
    first = {}
    for d, ws in words:
        for i in range(len(ws) - window + 1):
            w = tuple(ws[i : i + window])
            d_ = float("inf") if d is None else d
            first[w] = min(first.get(w, float("inf")), d_)
    out = []
    for d, ws in words:
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] < (float("inf") if d is None else d):
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def brute_strings(docs, length):
    texts = [(d, (t or "").encode()) for d, t in docs]
    count = {}
    for _, t in texts:
        for i in range(len(t) - length + 1):
            count[t[i : i + length]] = count.get(t[i : i + length], 0) + 1
    out = []
    for d, t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed, n=60):
    """Random texts with copies, edited copies, shared passages, periodic stretches and odd rows."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(40)]
    prose = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    shared = [prose(rng.randint(20, 90)) for _ in range(4)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.2:
            words = list(rng.choice(docs)[1])
            for _ in range(rng.choice([0, 1, 3])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        elif kind < 0.5:
            words = prose(rng.randint(0, 60)) + rng.choice(shared) + prose(rng.randint(0, 60))
        elif kind < 0.6:
            words = prose(5) + ["again", "and"] * rng.randint(20, 80)
        else:
            words = prose(rng.randint(0, 150))
        docs.append((i, words))
    rows = [(i, rng.choice([" ", "\n", "  "]).join(w)) for i, w in docs]
    rows += [(None, rows[3][1]), (None, rows[3][1]), rows[5], (9, rows[11][1]), (1000, None), (1001, ""), (1002, " \t ")]
    return rows


def results(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=str)


@pytest.mark.parametrize("seed,window", [(1, 50), (2, 13), (3, 2)])
def test_passages_equal_brute_force(spark, seed, window):
    docs = corpus(seed)
    got = remove_repeated_passages(spark.createDataFrame(docs, SCHEMA).repartition(5), window)
    assert results(got, "n_words", "n_removed", "kept_sha256") == brute_passages(docs, window)


@pytest.mark.parametrize("seed,length", [(4, 400), (5, 60), (6, 20)])
def test_strings_equal_brute_force(spark, seed, length):
    docs = corpus(seed)
    got = remove_repeated_strings(spark.createDataFrame(docs, SCHEMA).repartition(5), length)
    assert results(got, "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_strings(docs, length)


@pytest.mark.parametrize("operator", [remove_repeated_passages, remove_repeated_strings])
def test_empty_table_and_clashing_columns(spark, operator):
    names = "doc_id long, text string, doc long, key string, regions int, kept string, low int"
    assert operator(spark.createDataFrame([], names)).collect() == []
    text = " ".join(f"a{i}" for i in range(300))
    rows = [(1, text, 1, "x", 1, "y", 0), (2, text, 1, "x", 1, "y", 0)]
    removed = {r.doc_id: r.n_removed for r in operator(spark.createDataFrame(rows, names)).collect()}
    assert removed[2] > 0


def test_rows_without_any_repeat_keep_their_text(spark):
    docs = [(1, "one two  three"), (2, "four")]
    got = remove_repeated_passages(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {r.doc_id: (r.n_removed, r.kept) for r in got} == {1: (0, "one two three"), 2: (0, "four")}


@pytest.mark.parametrize("bits", [6, 8, 10])
def test_seeds_of_long_texts_are_the_same_in_segments(monkeypatch, bits):
    """A text of more symbols than positions have bits for is looked at in overlapping segments."""
    rng = np.random.default_rng(bits)
    shape = repeats.Shape(40, 9, (1,))
    bounds = np.array([0, 30, 30, 2500, 2510, 5000])
    seeds = rng.integers(0, 200, 4992).astype(np.uint64)  # ties: the first of equal ones
    want = repeats.seeds_of_windows(seeds, bounds, shape)
    monkeypatch.setattr(repeats, "POSITION_BITS", bits)
    got = repeats.seeds_of_windows(seeds, bounds, shape)
    assert len(want[0]) > 4000 and all((a == b).all() for a, b in zip(want, got))
    assert ((got[1] >= got[0]) & (got[1] < got[0] + shape.offsets)).all()


def test_thousands_of_copies_of_one_row_give_one_list_of_windows(spark):
    """Copies of one row share id and text; what is gathered for them does not grow with their number."""
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text)] * 5 + [(2, text)] + [(3, text)] * 5000 + [(4, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = remove_repeated_passages(df, window=50, with_text=False).select("doc_id", "n_words", "n_removed")
    assert {tuple(r) for r in got.distinct().collect()} == {(1, 120, 0), (2, 120, 120), (3, 120, 120), (4, 1, 0)}
    assert got.count() == len(rows)
