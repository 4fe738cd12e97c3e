"""Phrase collocations: against a plain count, over shards, hot words and odd texts."""

import re
from collections import Counter

import numpy as np
import pytest

from viewloom.llm import collocations as module
from viewloom.llm.collocations import collocations

SCHEMA = "doc_id long, text string, lang string, n long, phrase string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, longest=4, subsumed=80, most=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        f = counts.setdefault(lang or "und", Counter()) if lang is not None else counts.setdefault("und", Counter())
        key = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[key] += len(words)
            for k in range(1, longest + 1):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: n for p, n in f.items() if n >= least}
        scored = []
        for p, a in frequent.items():
            if len(p) < 2:
                continue
            if any(
                len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * b >= subsumed * a
                for q, b in frequent.items()
            ):
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def found(df):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, t, lang, 7, "x") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(parts)


@pytest.mark.parametrize("bits, least", [(27, 3), (8, 3), (27, 12), (8, 1)])
def test_equals_a_plain_count(spark, monkeypatch, bits, least):
    monkeypatch.setattr(module, "FILTER_BITS", bits)  # a small filter lets more through, but changes nothing
    monkeypatch.setattr(module, "MOST_COUNTS", 50)
    monkeypatch.setattr(module, "BATCH_ROWS", 16)
    monkeypatch.setattr(module, "HASH_BYTES", 64)
    rng = np.random.default_rng(1)
    vocabulary = ["the", "of", "Ämter", "naïve", "a", "B", "c", "dd", "rain", "new", "york"]
    rows = []
    for i in range(60):
        words = rng.choice(vocabulary, size=rng.integers(0, 60), p=rng.dirichlet(np.ones(len(vocabulary)) * 3))
        text = "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", " , ", ";"], p=[0.7, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05]) for w in words)
        rows.append((text, rng.choice(["en", "de"])))
    rows += [("New York is NEW york", "en")] * 40
    assert found(collocations(frame(spark, rows), least=least)) == plain(rows, least)


def test_every_row_may_be_a_shard_of_its_own(spark):
    rows = [("alpha beta gamma delta", "en"), ("alpha beta", "en")] * 15 + [("word " * 50, "en")]
    assert found(collocations(frame(spark, rows, parts=40), least=30)) == plain(rows, 30)


def test_odd_texts(spark):
    rows = [(None, "en"), ("", "en"), ("  \t\n..,", "fr"), ("one", None), ("a a a a a a", None), ("a a a", "und"), ("x y", "")]
    assert found(collocations(frame(spark, rows), least=2)) == plain(rows, 2)
    assert found(collocations(frame(spark, rows).limit(0), least=2)) == []
    assert found(collocations(frame(spark, rows), least=100)) == []


def test_long_text_ties_and_limit(spark, monkeypatch):
    monkeypatch.setattr(module, "TEXT_BYTES", 1000)
    rows = [("p q r s. " * 4000, "en"), ("z y x. " * 3000 + "w" * 70_000, "en"), ("b a, b a, a b, a b", "de")]
    assert found(collocations(frame(spark, rows), least=2, subsumed=101)) == plain(rows, 2, subsumed=101)
    assert found(collocations(frame(spark, rows), least=2, most=1)) == plain(rows, 2, most=1)
    assert found(collocations(frame(spark, rows), least=2, longest=2)) == plain(rows, 2, longest=2)


def test_scores_are_exact_past_64_bits(spark):
    n = 9_000_000_000_000_000
    phrases = spark.createDataFrame(
        [("en", "a b", 2, n), ("en", "a", 1, n), ("en", "b", 1, n + 1)], "lang string, phrase string, words int, n long"
    )
    row = module._cuts(phrases).first()
    assert (row.l, row.r, row.score) == (n, n + 1, 2_000_000 * n // (2 * n + 1))
