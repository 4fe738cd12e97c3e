"""Near-duplicate groups against all pairs, and their defined edge cases."""

import random
import re

from viewloom.llm import near_dedup
from viewloom.llm.near_dedup import near_duplicate_groups

SCHEMA = "doc_id long, text string"


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    big = float("inf")
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                group[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), big), big if d is None else d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = least[root(i)] if sets[i] else d
        c = None if c == big else c
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def corpus(seed, n=150):
    rng = random.Random(seed)
    prose = lambda k: [rng.choice(["Alpha", "beta", "gamma", "delta", "é"]) + str(rng.randrange(30)) for _ in range(k)]
    texts = []
    for _ in range(n):
        if texts and rng.random() < 0.7:
            words = list(rng.choice(texts[-30:]))
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                if words:
                    words[rng.randrange(len(words))] = "edit" + str(rng.randrange(5))
        else:
            words = prose(rng.choice([0, 1, 3, 4, 5, 40, 120, 200]))
        texts.append(words)
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(None, rows[0][1]), (None, "only here"), rows[1], rows[1], (5, rows[9][1]), (9000, None), (9001, " ")]


def answer(spark, rows, schema=SCHEMA):
    return sorted((tuple(r) for r in near_duplicate_groups(spark.createDataFrame(rows, schema)).collect()), key=str)


def test_groups_equal_all_pairs(spark):
    rows = corpus(1)
    assert answer(spark, rows) == brute(rows)


def test_groups_with_many_rounds_of_leaders(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "LEADERS", 2)
    rows = corpus(2, 80)
    assert answer(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, doc int, node int, root int, a int, kept string"
    assert answer(spark, [], schema) == []
    assert answer(spark, [(2, "x", 1, 1, 1, 1, "k"), (1, "X", 1, 1, 1, 1, "k")], schema) == [(1, 1, 1, True), (2, 1, 1, False)]


def test_very_long_texts_are_read_whole(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(50_000)}" for _ in range(100_000)]
    near = list(words)
    for _ in range(500):
        near[rng.randrange(len(near))] = "edit"
    rows = [(3, " ".join(words)), (2, " ".join(near)), (1, " ".join(words[:2000])), (4, " ".join(words[:50_000]))]
    assert answer(spark, rows) == brute(rows)
