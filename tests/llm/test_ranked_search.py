"""Ranked search: against a plain scorer, with small blocks, hot terms, ties and odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from viewloom.llm import ranked_search as module
from viewloom.llm.ranked_search import search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in set(items):
        ranked = []
        for i, bag, n in bags:
            m = 10 + 90 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in set(terms(text))
                if t in bag
            )
            if score > 0:
                ranked.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(ranked)[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def frames(spark, docs, items, parts=4):
    return (
        spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(parts),
        spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, term string"),
    )


def corpus(rng, n):
    vocabulary = [f"w{i}" for i in range(80)] + ["Ärger", "naïve", "ИМЯ"]
    p = 1 / np.arange(1, len(vocabulary) + 1)
    return lambda size: " ".join(rng.choice(vocabulary, size=size, p=p / p.sum())), range(n)


@pytest.mark.parametrize("chunk, block, terms_at_once", [(1024, 32, 8192), (16, 3, 20), (64, 1, 8192)])
def test_equals_a_plain_scorer(spark, monkeypatch, chunk, block, terms_at_once):
    monkeypatch.setattr(module, "CHUNK_DOCS", chunk)
    monkeypatch.setattr(module, "BLOCK_DOCS", block)
    monkeypatch.setattr(module, "MOST_TERMS", terms_at_once)
    rng = np.random.default_rng(chunk)
    text, ids = corpus(rng, 300)
    docs = [(i, text(rng.integers(1, 60))) for i in ids]
    docs += [(1000 + i, docs[7][1]) for i in range(100)]  # copies tie, and the smaller ids win
    items = [(i, text(rng.integers(1, 25)).upper()) for i in range(8)] + [(90, "THE w0"), (91, docs[7][1]), (92, "nowhere")]
    got = search(*frames(spark, docs, items))
    assert found(got) == plain(docs, items)


def test_odd_rows(spark):
    docs = [(None, "a b"), (3, "a"), (3, "a"), (3, "a c"), (4, None), (5, ""), (6, "!?"), (7, "A-b_c"), (2, "a"), (1, "zz " * 5000)]
    items = [(1, "a"), (1, "a"), (1, "b"), (None, "c zz"), (2, None), (3, ""), (4, "...")]
    d, b = frames(spark, docs, items)
    got = found(search(d, b, k=4))
    want = plain(docs, [i for i in items if i[1]], k=4)
    assert got == want
    assert found(search(d.limit(0), b)) == [] and found(search(d, b.limit(0))) == []
    assert search(d, b.limit(0)).dtypes == search(d, b).dtypes


def test_summaries_rule_out_blocks(spark):
    """Blocks of similar documents: most are skipped, and none that holds one of the best."""
    rng = np.random.default_rng(4)
    topics = [[f"t{j}x{i}" for i in range(12)] + ["the"] for j in range(10)]
    impacts = np.zeros((500, 121), np.int64)
    names = {t: i for i, t in enumerate(sorted({t for topic in topics for t in topic}))}
    for d in range(500):
        for t in rng.choice(topics[d % 10], size=6, replace=False):
            impacts[d, names[t]] = rng.integers(100, 1000)
    order = module.similarity_order(impacts)
    assert sorted(order) == list(range(500))
    wanted = [names[t] for t in topics[3] if t != "the"]
    bounds = np.maximum.reduceat(impacts[order], np.arange(0, 500, 20))[:, wanted].sum(1)
    scores = impacts[order][:, wanted].sum(1)
    least = np.sort(scores)[-10]
    assert (bounds < least).mean() > 0.5
    assert (np.repeat(bounds, 20) >= scores).all()
