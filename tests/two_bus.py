"""Two buses, three generators, a load and a link: a study with known results.

Over t = 1..24: A1 = A2 = t at bus A, B1 = 100 - 2t at bus B, a constant load of 100 at
bus A, and a link that carries 100 - 2t from bus A to bus B.
"""

from __future__ import annotations

import json
from datetime import datetime, timedelta
from pathlib import Path

from viewloom.schemas import SIMULATION_SCHEMA

BALANCE_PORT = "p_balance_port"

# The documents of the public two-bus study, as published; only CORRIDOR is added.
TAXONOMY = {
    "id": "my_taxonomy",
    "description": "two buses",
    "categories": [
        {"id": category, "ports": [{"id": port} for port in ports]}
        for category, ports in {
            "balance": [BALANCE_PORT, "q_balance_port"],
            "consumption": [BALANCE_PORT, "q_balance_port"],
            "production": [BALANCE_PORT],
            "storage": [BALANCE_PORT],
            "link": ["p0_port", "p1_port"],
            "coupling": ["emission_port"],
        }.items()
    ],
}
LIBRARY = {
    "id": "pypsa_models",
    "models": [
        {"id": model, "taxonomy-category": category}
        for model, category in {
            "bus": "balance",
            "load": "consumption",
            "generator": "production",
            "link": "link",
            "storage_unit": "storage",
            "store": "consumption",
            "global_constraint_co2_max": "coupling",
            "global_constraint_co2_eq": "coupling",
        }.items()
    ],
}
SYSTEM = {
    "id": "two_bus_example",
    "components": [
        {"id": component, "model": f"pypsa_models.{model}"}
        for component, model in {
            "generator_A1": "generator",
            "generator_A2": "generator",
            "generator_B1": "generator",
            "load_AL": "load",
            "busA": "bus",
            "busB": "bus",
            "link_link_AB": "link",
        }.items()
    ],
    "connections": [
        {"component1": bus, "port1": BALANCE_PORT, "component2": component, "port2": port}
        for bus, component, port in [
            ("busA", "generator_A1", BALANCE_PORT),
            ("busA", "generator_A2", BALANCE_PORT),
            ("busB", "generator_B1", BALANCE_PORT),
            ("busA", "load_AL", BALANCE_PORT),
            ("busA", "link_link_AB", "p0_port"),
            ("busB", "link_link_AB", "p1_port"),
        ]
    ],
}


def metric(metric_id, *terms, terms_operator="sum", time_operator="sum"):
    return {
        "id": metric_id,
        "terms": [
            {"taxonomy-category": category, "output-id": output, "location-ports": ports}
            for category, output, ports in terms
        ],
        "terms-operator": terms_operator,
        "time-operator": time_operator,
    }


CATALOG = {
    "id": "test_example_pypsa",
    "taxonomy": "my_taxonomy",
    "location": {"taxonomy-category": "balance"},
    "metrics-definition": [
        metric("PROD", ("production", "p", BALANCE_PORT)),
        metric("LOAD", ("consumption", "active_load", BALANCE_PORT)),
        metric("INSTALLED_PROD_CAPACITY", ("production", "pnom", BALANCE_PORT)),
        metric("BALANCE", ("link", "p0_port.flow", "p0_port"), ("link", "p1_port.flow", "p1_port")),
        metric("CORRIDOR", ("link", "p0_port.flow", ["p0_port", "p1_port"]), terms_operator="avg"),
    ],
}


def view(*references, catalogs=("catalog",)):
    return {
        "id": "view_area",
        "scope": [{"location": None, "taxonomy-category": "balance"}, {"calendar": "calendar_file"}],
        "aggregation": [{"time": "hour"}],
        "catalog": [{"id": c} for c in catalogs],
        "metrics": [{"id": r} for r in references],
    }


def simulation_rows():
    rows = [("1", "load_AL", "active_load", None, None, 0, 100.0, "BASIC")]
    for t in range(1, 25):
        for component, output, value in [
            ("generator_A1", "p", t),
            ("generator_A2", "p", t),
            ("generator_B1", "p", 100 - 2 * t),
            ("link_link_AB", "p0_port.flow", 100 - 2 * t),
            ("link_link_AB", "p1_port.flow", 2 * t - 100),
        ]:
            rows.append(("1", component, output, t, t, 0, float(value), "BASIC"))
    return rows


def write_study(spark, path: Path, references=("catalog.PROD", "catalog.LOAD", "catalog.BALANCE")) -> None:
    (path / "catalogs").mkdir()
    for name, root, body in [
        ("taxonomy", "taxonomy", TAXONOMY),
        ("library", "library", LIBRARY),
        ("system", "system", SYSTEM),
        ("catalogs/catalog", "catalog", CATALOG),
        ("view_config", "view", view(*references)),
    ]:
        (path / f"{name}.json").write_text(json.dumps({root: body}, indent=1))
    start = datetime(2025, 1, 1)
    lines = [f"{i},1,{start + timedelta(hours=i)}" for i in range(25)]
    (path / "calendar_file.csv").write_text("\n".join(["absolute_time_index,block,granular_date", *lines]) + "\n")
    spark.createDataFrame(simulation_rows(), SIMULATION_SCHEMA).coalesce(1).write.parquet(
        str(path / "simulation_table.parquet")
    )
