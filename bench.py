"""Times the headline queries and prints one JSON line.

Every time is the median of three runs that compute all rows, after one warm-up run.
``*_on_table`` reads the simulation table from parquet, as a real study has it; the other
queries also derive it from the benchmark tables. ``naive`` is the plain form, for comparison; it
is not part of the total.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from dataclasses import replace

from pyspark.sql import SparkSession

import viewloom as vl
from studies.naive import naive_view
from studies.queries import QUERIES
from studies.tables import events_study, lineitem_study
from viewloom.staging import stage

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("viewloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="viewloom-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(make) -> float:
    seconds = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds[1:]), 3)


def main() -> None:
    spark = session()
    study = lineitem_study(spark, SF_DIR)
    stored = replace(study, simulation=stage(study.simulation.repartition(int(CPUS)), "simulation"))
    events = events_study(spark, SF_DIR)
    headline = {
        name: (lambda query=QUERIES[name]: query(spark, SF_DIR))
        for name in ("filter_by_calendar", "metric_structure", "terms_sum", "build_view", "view_round_trip")
    }
    headline["build_view_events"] = lambda: vl.build_view(events)
    headline["filter_on_table"] = lambda: vl.filter_by_calendar(stored.simulation, stored.calendar)
    headline["build_view_on_table"] = lambda: vl.build_view(stored)
    queries = {name: timed(make) for name, make in headline.items()}
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": queries,
        "naive": {"build_view_on_table": timed(lambda: naive_view(stored))},
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
        "shuffle_partitions": int(CPUS),
        "runs": RUNS,
        "simulation_rows": stored.simulation.count(),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
