"""Language and quality: held-out accuracy, arrays against a plain walk, and the defined edge cases."""

import random

import numpy as np
import pyarrow as pa
import pytest

from viewloom.llm import language, quality
from viewloom.llm.text import blocks

DOCS = "doc_id long, text string, lang string, source string"
WORDS = {
    "en": "the of and that with from this which are have water light",
    "de": "der die und nicht über für größer eine ist wasser licht schön",
    "fr": "le la les être où déjà avec une eau lumière pas très",
}


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(5)
    rows = []
    for i in range(600):
        lang = rng.choice(sorted(WORDS))
        words = WORDS[lang].split()
        text = " ".join(rng.choice(words) for _ in range(rng.randint(3, 60)))
        if i % 6 == 0:
            text = " ".join(rng.choice(words) + "$$$" for _ in range(20))
        rows.append((i, text, lang, "s"))
    return rows


def test_language_of_held_out_rows(spark, documents):
    odd = [(9000, None, "en", "s"), (9001, "", None, "s"), (9002, "123 $$ ...", "de", "s"), (None, "der die und", None, "s")]
    docs = spark.createDataFrame(documents + odd + [documents[0]], DOCS)
    got = language.predict(docs, language.train(docs)).collect()
    truth = {r[0]: r[2] for r in documents}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97
    by_id = {r.doc_id: r for r in got}
    assert [by_id[i].lang_pred for i in (9000, 9001, 9002)] == ["und"] * 3
    assert by_id[None].lang_pred == "de" and not by_id[None].held_out
    assert all(0 <= r.score <= 1 for r in got) and len(got) == len(documents) + 5


def test_strange_text_is_rejected(spark, documents):
    docs = spark.createDataFrame(documents, DOCS)
    model = language.train(docs)
    strange = spark.createDataFrame([(1, "щука ѣ 漢字漢字 ωψ", None, "s")], DOCS)
    assert [r.rejected for r in language.predict(strange, model).collect()] == [True]
    assert [r.lang_pred for r in language.predict(strange, language.train(strange)).collect()] == ["und"]


def test_quality_of_held_out_rows(spark, documents):
    docs = spark.createDataFrame([(*r, 1, 2) for r in documents], DOCS + ", score int, x int")
    labels = [(r[0], int("$" not in r[1]), 0) for r in documents]
    odd = [(1, None, 0), (None, 1, 0), (777777, 1, 1), labels[2]]
    labels = spark.createDataFrame(labels + odd, "doc_id long, quality int, toxic int")
    got = quality.score_quality(docs, quality.train(docs, labels)).collect()
    truth = {r[0]: int("$" not in r[1]) for r in documents}
    held = [r for r in got if r.held_out]
    assert len(held) > 60
    assert all(r.predicted == truth[r.doc_id] for r in held)


def test_quality_edge_cases(spark, documents):
    docs = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (None, "a " * 50000, "", ""), (4, "é", "", "")], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    forest = quality.train(docs, labels)
    got = quality.score_quality(docs, forest).collect()
    assert [r.score for r in got] == [0.5] * 4
    assert quality.score_quality(docs.limit(0), forest).collect() == []
    assert quality.keep_good(docs, forest).columns == docs.columns


def test_copies_of_one_row_neither_outweigh_nor_reach_the_driver(spark, documents, monkeypatch):
    docs = spark.createDataFrame(documents, DOCS)
    copies = docs.where("doc_id = 7").crossJoin(spark.range(10_000)).drop("id")
    labels = spark.createDataFrame([(r[0], int("$" not in r[1])) for r in documents], "doc_id long, quality int")
    grown, grow = [], quality.grow
    monkeypatch.setattr(quality, "grow", lambda x, y: grown.append(len(y)) or grow(x, y))
    plain, hot = quality.train(docs, labels), quality.train(docs.unionByName(copies), labels)
    assert grown[0] == grown[1] <= len(documents)
    assert np.array_equal(plain.threshold, hot.threshold) and np.array_equal(plain.value, hot.value)

    fitted, fit = [], language.fit
    monkeypatch.setattr(language, "fit", lambda names, counts, *more: fitted.append(len(names)) or fit(names, counts, *more))
    plain, hot = language.train(docs), language.train(docs.unionByName(copies))
    assert fitted[0] == fitted[1] <= len(documents)
    assert np.array_equal(plain.centroids, hot.centroids)


def test_very_long_texts_are_read_whole(spark, documents):
    rng = random.Random(6)
    german, english = (" ".join(rng.choice(WORDS[x].split()) for _ in range(200_000)) for x in ("de", "en"))
    rows = [(1, english[:2000] + german, None, "s"), (2, german[:2000] + english, None, "s"), (3, "light $$$", None, "s")]
    long = spark.createDataFrame(rows, DOCS)
    got = language.predict(long, language.train(spark.createDataFrame(documents, DOCS))).collect()
    assert [r.lang_pred for r in got[:2]] == ["de", "en"]
    batch = pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows])], ["text"])
    together = np.concatenate([quality.statistics(b) for b in blocks(iter([batch]), size=1 << 30)])
    alone = np.concatenate([quality.statistics(b) for b in blocks(iter([batch]), size=1)])
    assert np.allclose(together, alone)
    words = [len(r[1].split()) for r in rows]
    assert np.allclose(together[:, :2], [[np.log1p(len(r[1])), np.log1p(n)] for r, n in zip(rows, words)])


def test_flat_forest_equals_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 1] * x[:, 2] > 0.2)).astype(float)
    forest = quality.grow(x, y)

    def walk(row):
        total = forest.base
        for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value):
            i = 0
            while i < len(feature):
                i = 2 * i + (2 if row[feature[i]] > threshold[i] else 1)
            total += value[i - len(feature)]
        return 1 / (1 + np.exp(-total))

    scores = forest.scores(x)
    assert np.allclose(scores, [walk(r) for r in x])
    assert ((scores > 0.5) == y).mean() > 0.95


def test_blocks_keep_texts_whole():
    texts = ["a" * 70, None, "", "é" * 400, "b"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    seen = []
    for block in blocks(iter([batch.slice(1)]), size=100, most=2):
        seen += [block.data[a:b].tobytes().decode() for a, b in zip(block.bounds[:-1], block.bounds[1:])]
    assert seen == [t or "" for t in texts[1:]]
