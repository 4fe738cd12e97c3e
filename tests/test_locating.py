import pytest
from pyspark.sql import functions as F

from viewloom import components_by_model, instances_of_model, locate, models_by_category, models_in_category
from viewloom import peer_violations, port_edges
from viewloom import schemas as S

CONNECTIONS = [
    ("a", "p", "hub", "q"),
    ("a", "p", "hub", "q"),  # copy
    ("b", "p", "hub", None),  # far port defaults to p
    ("b", "r", "east", "r"),
    ("c", "p", "x", "p"),
    ("c", "p", "y", "p"),
    ("d", "p", "d", "p"),  # self
    ("e", None, "x", "p"),
    (None, "p", "x", "p"),
    ("f", "p", None, "p"),
]


@pytest.fixture(scope="module")
def connections(spark):
    return spark.createDataFrame(CONNECTIONS, S.CONNECTIONS_SCHEMA)


def test_edges_are_a_set_in_both_directions(connections):
    assert {tuple(r) for r in port_edges(connections).collect()} == {
        ("a", "p", "hub"), ("hub", "q", "a"),
        ("b", "p", "hub"), ("hub", "p", "b"),
        ("b", "r", "east"), ("east", "r", "b"),
        ("c", "p", "x"), ("x", "p", "c"),
        ("c", "p", "y"), ("y", "p", "c"),
    }
    assert port_edges(connections).count() == 10


def test_peer_violations(spark, connections):
    needed = spark.createDataFrame([("a", "p"), ("c", "p"), ("d", "p"), ("zzz", "p")], "component string, port string")
    assert {tuple(r) for r in peer_violations(needed, connections).collect()} == {
        ("c", "p", "several_peers: c.p"),
        ("d", "p", "no_peer: d.p"),
        ("zzz", "p", "no_peer: zzz.p"),
    }


def test_locate(spark, connections):
    rows = spark.createDataFrame(
        [
            (1, "a", None),
            (2, "a", ["p"]),
            (3, "b", ["r", "p"]),
            (4, "b", ["p", "r"]),
            (5, "b", ["p", "p"]),
            (6, "a", []),
            (7, "a", ["zzz", "p"]),
            (8, "c", ["p"]),
        ],
        "id int, component string, location_ports array<string>",
    )
    located = {r["id"]: (r["metric_location"], r["location_problem"]) for r in locate(rows, ["id", "component"], connections).collect()}
    assert located == {
        1: ("a", None),
        2: ("hub", None),
        3: ("east|hub", None),
        4: ("hub|east", None),
        5: ("hub|hub", None),
        6: ("", None),
        7: (None, "no_peer: a.zzz"),
        8: (None, "several_peers: c.p"),
    }


def test_component_and_model_indexes(spark):
    components = spark.createDataFrame(
        [("c1", "lib.m"), ("c1", "lib.m"), ("c2", "m"), ("c3", None), ("c4", "other.m")], S.COMPONENTS_SCHEMA
    )
    assert sorted(tuple(r) for r in components_by_model(components).collect()) == [
        ("lib.m", "c1"), ("lib.m", "c1"), ("other.m", "c4"),
    ]
    assert [r[0] for r in instances_of_model(components, "other.m").collect()] == ["c4"]
    assert instances_of_model(components, "lib.none").isEmpty()
    models = spark.createDataFrame(
        [("lib", 0, "m", "x"), ("lib", 1, "m", "x"), ("lib", 2, "n", ""), ("lib", 3, "o", None)], S.MODELS_SCHEMA
    )
    assert [tuple(r) for r in models_by_category(models).collect()] == [("x", "m"), ("x", "m")]
    assert models_in_category(models, "y").isEmpty()


def test_hub_peers_are_never_gathered(connections):
    from tests.plans import formatted
    from viewloom.operators.locating import port_peers

    plan = formatted(port_peers(connections))
    assert "collect_" not in plan and plan.count("partial_min") >= 1
    assert port_peers(connections).filter(F.col("ambiguous")).count() == 1


def test_structure_rows_are_joined_once_with_a_map_of_peers(spark, connections):
    """No row a port, no regathering: one exchange of the rows, none at all if the map is broadcast."""
    from tests.plans import formatted

    rows = spark.createDataFrame([(1, "b", ["r", "p"])], "id int, component string, location_ports array<string>")
    plan = formatted(locate(rows.hint("merge"), ["id", "component"], connections))
    assert "collect_list" not in plan
    of_rows = plan.split("SortMergeJoin LeftOuter")[1].split("Scan ExistingRDD (1)")[0]
    assert of_rows.count("Exchange") == 1 and "Generate" not in of_rows and "Aggregate" not in of_rows


def test_only_ports_of_terms_enter_a_map(spark):
    """A hub with ten thousand ports: its map holds the two that are asked for."""
    from viewloom.operators.locating import port_maps

    hub = spark.range(10_000).selectExpr(
        "'hub' AS component1", "concat('p', id) AS port1", "concat('c', id) AS component2", "'home' AS port2"
    )
    asked = spark.createDataFrame([("p7",), ("p9999",), ("none",)], "port string")
    maps = {r["component"]: r["peers"] for r in port_maps(hub, asked).collect()}
    assert {p: e["peer"] for p, e in maps["hub"].items()} == {"p7": "c7", "p9999": "c9999"} and len(maps) == 1
    rows = spark.createDataFrame(
        [(1, "hub", ["p9999", None, "p7"]), (2, None, ["p7"]), (3, None, None), (4, "hub", [None])],
        "id int, component string, location_ports array<string>",
    )
    located = {r["id"]: r["metric_location"] for r in locate(rows, ["id"], hub).collect()}
    assert located == {1: "c9999|c7", 2: "", 3: None, 4: ""}
