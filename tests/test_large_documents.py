"""A JSON document read in several tasks: against a plain parser, whatever the splits cut through."""

import json
import random

import pytest

from viewloom.sources import documents as docs
from viewloom.sources.large_documents import array_items, json_items

ODD = ['a}b', '{', '}', '"', '\\', 'x\\"}{', '[{', '], "connections": [{', 'ä}ö', "line\nbreak}", "\\\\", "", "\t{\"id\": 1}", "🙂}"]


@pytest.fixture
def splits(spark):
    """Splits of a few hundred bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    yield lambda size: [spark.conf.set(name, str(size)) for name in names]
    for name, value in before.items():
        spark.conf.set(name, value)


def system(rng, n, m):
    text = lambda: "".join(rng.choice([*ODD, "c", "7"]) for _ in range(rng.randint(0, 3)))
    nested = lambda: [{"id": text(), "value": {"of": [{"x": text()}]}} for _ in range(rng.randint(0, 2))]
    components = [{"id": f"c{i}{text()}", "parameters": nested(), "model": f"lib.{text()}"} for i in range(n)]
    connections = [{"component1": f"c{i}", "port1": text(), "component2": text(), "port2": None} for i in range(m)]
    return {"id": text(), "note": {"id": "no item }"}, "components": components, "empty": [], "connections": connections, "more": {"id": "no"}}


@pytest.mark.parametrize("size, seed, indent, ascii_only", [(1 << 20, 1, 2, True), (700, 700, None, True), (300, 3, 2, False)])
def test_items_equal_a_plain_parser(spark, tmp_path, splits, size, seed, indent, ascii_only):
    rng = random.Random(seed)
    body = system(rng, 40, 15)
    path = tmp_path / "system.json"
    path.write_text(json.dumps({"system": body}, indent=indent, ensure_ascii=ascii_only) + "\n", encoding="utf-8")
    splits(size)
    items = json_items(spark, str(path)).collect()
    found = {}
    for row in items:
        found.setdefault(row["array"], []).append(json.dumps(json.loads(row["item"]), sort_keys=True))
    assert set(found) == {"components", "connections", ""}
    for array in ("components", "connections"):
        assert sorted(found[array]) == sorted(json.dumps(item, sort_keys=True) for item in body[array])
    components, connections = docs.read_system(spark, str(path), large=0)
    small, plain = docs.read_system(spark, str(path), large=1 << 40)
    assert sorted(map(str, components.collect())) == sorted(map(str, small.collect()))
    assert sorted(map(str, connections.collect())) == sorted(map(str, plain.collect()))
    assert components.columns == small.columns and connections.columns == plain.columns


def test_a_system_of_a_million_components_is_read_in_several_tasks(spark, tmp_path, splits):
    n = 1_000_000
    path = tmp_path / "system.json"
    with path.open("w") as out:
        out.write('{"system": {"id": "s", "components": [')
        out.write(",".join(f'{{"id": "c{i}", "model": "lib.m{i % 7}"}}' for i in range(n)))
        out.write('], "connections": [{"component1": "c0", "port1": "p", "component2": "c1", "port2": "q"}]}}')
    splits(4 << 20)
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 4
    components, connections = docs.read_system(spark, str(path), large=1 << 20)
    counted = {r["model_ref"]: r["count"] for r in components.groupBy("model_ref").count().collect()}
    assert counted == {f"lib.m{k}": len(range(k, n, 7)) for k in range(7)}
    assert components.select("component").distinct().count() == n
    assert [tuple(r) for r in connections.collect()] == [("c0", "p", "c1", "q")]


@pytest.mark.parametrize("text", ['{"system": {"id": "x", "components": [], "connections": []}}', '{"system": {}}', "{}"])
def test_documents_without_items(spark, tmp_path, text):
    path = tmp_path / "system.json"
    path.write_text(text)
    assert json_items(spark, str(path)).collect() == []
    assert array_items(json_items(spark, str(path)), "components", docs.COMPONENT).collect() == []
