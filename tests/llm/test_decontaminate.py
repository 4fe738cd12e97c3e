"""Contamination against brute force, proximity, and the defined edge cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from viewloom.llm.decontaminate import build_index, contamination, proximity_matches
from viewloom.llm.shared import Staging, keyed

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window, one_in):
    windows = {}
    for i, t in items:
        w = tokens(t)
        k = min(window, len(w))
        for a in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[a : a + k]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, ids = tokens(t), set(), set()
        for k in {len(x) for x in windows}:
            for a in range(len(w) - k + 1):
                if found := windows.get(tuple(w[a : a + k])):
                    hit.update(range(a, a + k))
                    ids |= found
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, len(hit) > 0 and one_in * len(hit) >= len(w)))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "a"] * 5 + [f"Wörd{i}" for i in range(25)] + ["x1", "ΑΒΓ"]
    prose = lambda k: " ".join(rng.choice(vocabulary) + rng.choice(["", "", ",", ".\n", "-"]) for _ in range(k))
    items = [(i, prose(rng.choice([1, 3, 12, 13, 14, 40]))) for i in range(20)]
    items += [(None, prose(15)), (3, prose(20)), items[5], (99, None), (98, "..."), (97, "the the the the")]
    docs = []
    for i in range(80):
        parts = [prose(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words = (rng.choice(items)[1] or "").split(" ")
            a = rng.randrange(len(words))
            parts += [" ".join(words[a:] if rng.random() < 0.5 else words[: a + 1]).upper(), prose(rng.randint(0, 30))]
        docs.append((i, rng.choice([" ", " -- ", "\n"]).join(parts)))
    return docs + [(None, docs[2][1]), docs[4], (7, docs[9][1]), (500, None), (501, ""), (502, "?!")], items


@pytest.mark.parametrize("seed,window", [(1, 13), (2, 2)])
def test_contamination_equals_brute_force(spark, seed, window):
    docs, items = corpus(seed)
    got = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), window, 20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, window, 20)


def test_empty_tables_and_clashing_columns(spark):
    schema = DOCS + ", key int, term string, pos int, item int"
    rows = [(1, "one two", 0, "", 0, 0)]
    none = spark.createDataFrame([], ITEMS + ", size int, doc_id int")
    some = spark.createDataFrame([(1, "one", 4, 4)], ITEMS + ", size int, doc_id int")
    assert [r.n_hit for r in contamination(spark.createDataFrame(rows, schema), none).collect()] == [0]
    assert [r.n_hit for r in contamination(spark.createDataFrame(rows, schema), some).collect()] == [1]
    assert contamination(spark.createDataFrame([], schema), some).collect() == []


def test_no_python_in_the_plan(spark):
    docs, items = corpus(3)
    plan = contamination(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())


def test_proximity_takes_any_order_within_the_span(spark):
    docs = [(1, "c x a x b"), (2, "a " + "x " * 30 + "b c"), (3, "a b c a b c")]
    items = [(1, "a b c"), (2, "a unknown")]
    docs = keyed(spark.createDataFrame(docs, DOCS), "doc_id", "text")
    index = build_index(docs, spark.createDataFrame(items, ITEMS), Staging(spark, "test"))
    got = proximity_matches(index, rarest=3, within=6).select("doc", "item_id", F.col("span").cast("int"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "1", 5), (3, "1", 3)]
