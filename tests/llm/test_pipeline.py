"""The pipeline on documents with a known fate, against plain forms of its stages, and the edge cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_decontaminate import brute as brute_contamination
from tests.llm.test_mixing import plain_targets
from tests.llm.test_near_dedup import brute as brute_groups
from viewloom.llm.secret_scan import findings, masked

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    rng = random.Random(12)
    prose = lambda k: " ".join(f"word{rng.randrange(3000)}" for _ in range(k))
    items = [(i, prose(30)) for i in range(5)]
    docs, labels = [], []
    for i in range(400):
        text, good = prose(rng.randint(20, 120)), 1
        if i % 8 == 1:
            text, good = " ".join(w + "$$$" for w in text.split()), 0
        elif i % 8 == 2:
            text = docs[i - 2][1] + " tail"
        elif i % 8 == 4:
            text = text + " " + rng.choice(items)[1]
        elif i % 8 == 5:
            text += " password = abcdef123456 "
        docs.append((i, text, "en", rng.choice(["a", "a", "b", None]), len(text)))
        if i % 3:
            labels.append((i, good, 0))
    odd = [(None, "short", None, "b", None), (900, None, None, None, None), (900, None, None, None, None), docs[7]]
    return docs + odd, labels, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs, labels, items = rows()
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_equal_plain_forms(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    _, _, items = rows()
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        before[name] = [tuple(r) for r in docs.collect()]
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), DOCS + (", copies long" if name.startswith("mixing") else ""))
    after = [tuple(r) for r in docs.collect()]
    quality, near, clean, secrets, mix = before.values()

    assert not any("$$$" in (r[1] or "") for r in near)
    assert {r[0] for r in quality if "$$$" not in (r[1] or "")} == {r[0] for r in near}
    kept = {g[0] for g in brute_groups([(r[0], r[1]) for r in near]) if g[3]}
    assert sorted((r[0] for r in clean), key=str) == sorted(kept, key=str)
    bad = {c[0] for c in brute_contamination([(r[0], r[1]) for r in clean], items, 13, 20) if c[5]}
    assert bad and {r[0] for r in secrets} == {r[0] for r in clean} - bad
    want = {r[0]: masked(r[1], findings(r[1]), "[secret]") if r[1] else r[1] for r in secrets}
    assert {r[0]: r[1] for r in mix} == want
    assert all(r[4] == (None if r[1] is None else len(r[1])) for r in mix)
    sizes = {}
    for r in mix:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    taken = dict.fromkeys(sizes, 0)
    for r in after:
        taken[r[3]] += r[5] * len(r[1].split())
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 60


def test_run_applies_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == [*corpus_pipeline.COLUMNS, "copies"]
    assert out.where(F.col("text").contains("abcdef123456") | F.col("text").contains("$$$")).isEmpty()
    assert out.count() > 100


def test_stages_take_an_empty_table(spark, folder):
    empty = spark.createDataFrame([], DOCS + ", doc int, key int, copies int")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).collect() == []
