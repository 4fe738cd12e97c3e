"""Spark tables of the three studies.

* lineitem: suppliers are components, their quantities and prices the outputs, days the
  time steps, line numbers the scenarios.
* events: users are components, event types the outputs, hours the time steps.
* registry: large metadata (references, definitions, models) from orders and part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom import Study
from viewloom import schemas as S


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _named(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.col(key).cast("string"))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, list):
        return f"array({', '.join(_literal(v) for v in value)})"
    return str(value) if isinstance(value, int) else f"'{value}'"


def _rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Small fixed tables as literals, whose size the optimizer knows."""
    fields = T.StructType.fromDDL(schema).fields
    listed = ", ".join(f"({', '.join(_literal(v) for v in row)})" for row in rows)
    values = spark.sql(f"SELECT * FROM VALUES {listed} AS t({', '.join(f.name for f in fields)})")
    return values.select(*(F.col(f.name).cast(f.dataType) for f in fields))


# The metadata that both fact studies share.
CATEGORY_PORTS = {"production": ["home", "hub"], "consumption": ["home", "hub"], "location": []}
MODELS = [("lib", 0, "m0", "production"), ("lib", 1, "m1", "production"), ("lib", 2, "m2", "consumption"), ("lib", 3, "m3", None)]
LINEITEM_TERMS = [
    ("c1", "PROD", 0, "production", "qty", ["home"]),
    ("c1", "PRICE_AVG", 0, "production", "price", ["home", "hub"]),
    ("c1", "BAL", 0, "production", "acctbal", None),
    ("c1", "GHOST", 0, "consumption", "pnom", ["home"]),
    ("c1", "MIX", 0, "production", "qty", ["hub"]),
    ("c1", "MIX", 1, "consumption", "qty", ["hub"]),
    ("c2", "PROD", 0, "consumption", "qty", ["hub"]),
]
LINEITEM_REFERENCES = [
    "c1.PROD", "c1.PROD", "c1.PRICE_AVG", "c2.PROD", "c1.BAL", "c1.GHOST", "c1.MIX", "c1.NOPE",
]
EVENT_TERMS = [
    ("e", "CLICKS", 0, "production", "click", ["home"]),
    ("e", "CLICKS", 1, "consumption", "click", ["home"]),
    ("e", "SPEND_AVG", 0, "production", "purchase", None),
    ("e", "ERRORS_AVG", 0, "consumption", "error", ["home"]),
    ("e", "SIGNUPS", 0, "production", "signup", ["home", "hub"]),
]
EVENT_REFERENCES = ["e.CLICKS", "e.SPEND_AVG", "e.ERRORS_AVG", "e.SIGNUPS"]


def _shared_metadata(spark: SparkSession, terms: list[tuple], references: list[str]) -> dict[str, DataFrame]:
    metrics = [
        (catalog, metric, "avg" if metric.endswith("_AVG") else "sum", "sum")
        for catalog, metric in dict.fromkeys(t[:2] for t in terms)
    ]
    catalogs = [(key, key, "tax") for key in dict.fromkeys(t[0] for t in terms)]
    return {
        "taxonomy": _rows(spark, [("tax", c, None) for c in CATEGORY_PORTS], S.TAXONOMY_SCHEMA),
        "taxonomy_ports": _rows(
            spark, [(c, p) for c, ports in CATEGORY_PORTS.items() for p in ports], S.TAXONOMY_PORTS_SCHEMA
        ),
        "models": _rows(spark, MODELS, S.MODELS_SCHEMA),
        "catalogs": _rows(spark, catalogs, S.CATALOGS_SCHEMA),
        "metrics": _rows(spark, metrics, S.METRICS_SCHEMA),
        "terms": _rows(spark, terms, S.TERMS_SCHEMA),
        "references": _rows(spark, list(enumerate(references)), S.REFERENCES_SCHEMA),
    }


def _daily(spark: SparkSession, steps: int, date: str, block: str) -> DataFrame:
    return spark.range(steps).select(
        F.col("id").alias("absolute_time_index"), F.expr(block).alias("block"), F.expr(date).alias("granular_date")
    )


# Lineitem study.


def lineitem_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = F.datediff("l_shipdate", F.lit("1995-01-02").cast("date")).cast("long")
    outputs = F.array(
        F.struct(F.lit("qty").alias("output"), F.col("l_quantity").alias("value")),
        F.struct(F.lit("price").alias("output"), F.col("l_extendedprice").alias("value")),
    )
    lines = table(spark, sf_dir, "lineitem").select(
        _named("s", "l_suppkey").alias("component"),
        index.alias("absolute_time_index"),
        F.col("l_linenumber").cast("long").alias("scenario_index"),
        F.explode(outputs).alias("o"),
    )
    timed = lines.select(
        F.floor(F.col("absolute_time_index") / 365).cast("string").alias("block"),
        "component",
        "o.output",
        "absolute_time_index",
        (F.col("absolute_time_index") % 365).alias("block_time_index"),
        "scenario_index",
        "o.value",
        F.lit("BASIC").alias("basis_status"),
    )
    none = F.lit(None).cast("long")
    constant = table(spark, sf_dir, "supplier").select(
        F.lit("0").alias("block"),
        _named("s", "s_suppkey").alias("component"),
        F.lit("acctbal").alias("output"),
        none.alias("absolute_time_index"),
        none.alias("block_time_index"),
        none.alias("scenario_index"),
        F.col("s_acctbal").alias("value"),
        F.lit("BASIC").alias("basis_status"),
    )
    return timed.unionByName(constant)


def lineitem_calendar(spark: SparkSession) -> DataFrame:
    """2000 days; the blocks of days 730..759 match nothing."""
    return _daily(
        spark,
        2000,
        "cast(date_add(date'1995-01-02', cast(id as int)) as timestamp_ntz)",
        "if(id between 730 and 759, '-1', cast(floor(id / 365) as string))",
    )


def lineitem_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        _named("s", "s_suppkey").alias("component"),
        F.when(key % 10 == 9, "m1").otherwise(F.concat(F.lit("lib.m"), (key % 4).cast("string"))).alias("model_ref"),
    )


def lineitem_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier hangs on its nation (``home``) and region (``hub``); some have two
    ``aux`` peers, one is connected to itself and one row lacks its port."""
    located = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    name = _named("s", "s_suppkey")
    key = F.col("s_suppkey")
    none = F.lit(None).cast("string")

    def link(component1, port1, component2, port2):
        return F.struct(
            component1.alias("component1"), port1.alias("port1"), component2.alias("component2"), port2.alias("port2")
        )

    nation, region = F.col("n_name"), F.col("r_name")
    links = F.array(
        link(nation, F.lit("home"), name, none),
        link(name, F.lit("hub"), region, F.lit("hub")),
        F.when(key % 25 == 24, link(name, F.lit("aux"), nation, F.lit("aux"))),
        F.when(key % 25 == 24, link(name, F.lit("aux"), region, F.lit("aux"))),
        F.when(key == 1, link(name, F.lit("aux"), name, F.lit("aux"))),
        F.when(key == 2, link(name, none, nation, F.lit("aux"))),
    )
    return located.select(F.explode(F.filter(links, lambda x: x.isNotNull())).alias("l")).select("l.*")


def lineitem_study(spark: SparkSession, sf_dir: str) -> Study:
    return Study(
        simulation=lineitem_simulation(spark, sf_dir),
        calendar=lineitem_calendar(spark),
        components=lineitem_components(spark, sf_dir),
        connections=lineitem_connections(spark, sf_dir),
        **_shared_metadata(spark, LINEITEM_TERMS, LINEITEM_REFERENCES),
    )


# Events study.


def events_simulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    signup = F.col("event_type") == "signup"
    hour = F.expr("timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts)").cast("long")
    index = F.when(~signup, hour)
    return table(spark, sf_dir, "events").select(
        F.when(hour < 400, "1").otherwise("2").alias("block"),
        _named("u", "user_id").alias("component"),
        F.col("event_type").alias("output"),
        index.alias("absolute_time_index"),
        index.alias("block_time_index"),
        F.when(~signup, F.col("event_id") % 3).alias("scenario_index"),
        "value",
        F.lit("BASIC").alias("basis_status"),
    )


def events_calendar(spark: SparkSession) -> DataFrame:
    """600 hours; the blocks of hours 360..399 match nothing."""
    return _daily(
        spark,
        600,
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id as int))",
        "if(id < 360, '1', '2')",
    )


def events_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        _named("u", "c_custkey").alias("component"),
        F.concat(F.lit("lib.m"), (F.col("c_custkey") % 4).cast("string")).alias("model_ref"),
    )


def events_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    links = F.array(
        F.struct(F.lit("home").alias("port1"), F.col("n_name").alias("component2")),
        F.struct(F.lit("hub").alias("port1"), F.col("c_mktsegment").alias("component2")),
    )
    return located.select(_named("u", "c_custkey").alias("component1"), F.explode(links).alias("l")).select(
        "component1", "l.port1", "l.component2", F.lit(None).cast("string").alias("port2")
    )


def events_study(spark: SparkSession, sf_dir: str) -> Study:
    return Study(
        simulation=events_simulation(spark, sf_dir),
        calendar=events_calendar(spark),
        components=events_components(spark, sf_dir),
        connections=events_connections(spark, sf_dir),
        **_shared_metadata(spark, EVENT_TERMS, EVENT_REFERENCES),
    )


# Registry study: metadata that grows with the tables.


def registry_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reference per order; a few are malformed, some name nothing."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("pos"),
        F.when(key % 50 == 0, F.concat(F.lit("."), F.col("o_orderstatus")))
        .when(key % 50 == 1, F.col("o_orderstatus"))
        .when(key % 50 == 2, F.concat(F.col("o_orderstatus"), F.lit(".")))
        .otherwise(
            F.concat(
                F.lit("c"),
                (F.col("o_custkey") % 7).cast("string"),
                F.lit(".M"),
                (key % 47).cast("string"),
                F.lit("."),
                F.col("o_orderstatus"),
            )
        )
        .alias("reference"),
    )


def registry_definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metric definitions in order; later ones replace earlier ones of the same id."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), (key % 5).cast("string")).alias("catalog_key"),
        F.concat(F.lit("M"), (key % 41).cast("string"), F.when(key % 2 == 0, ".F").otherwise(".O")).alias("metric_id"),
        key.alias("pos"),
        F.when(size == 7, "max").when(size % 3 == 0, "avg").otherwise("sum").alias("terms_operator"),
        F.when(size % 10 == 0, "avg").otherwise("sum").alias("time_operator"),
    )


def registry_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.concat(F.lit("c"), (key % 5).cast("string")).alias("catalog_key"),
        F.concat(F.lit("P"), key.cast("string")).alias("metric_id"),
        F.lit(0).alias("term_ord"),
        F.when(size == 11, F.lit(None)).otherwise(F.lower("p_type")).alias("taxonomy_category"),
        F.when(size != 13, F.col("p_brand")).alias("output_id"),
        F.when(size % 4 == 0, F.lit(None))
        .when(size % 4 == 1, F.array(F.lit("home")))
        .when(size % 4 == 2, F.array(F.lit("home"), F.lit("hub")))
        .otherwise(F.array(F.lit("hub"), F.lit("dock")))
        .alias("location_ports"),
    )


def registry_catalogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five catalogs; c3 belongs to another taxonomy."""
    key = F.concat(F.lit("c"), (F.col("p_partkey") % 5).cast("string"))
    return (
        table(spark, sf_dir, "part")
        .select(key.alias("catalog_key"))
        .distinct()
        .select(
            "catalog_key",
            F.col("catalog_key").alias("catalog_id"),
            F.when(F.col("catalog_key") == "c3", "other").otherwise("tax").alias("taxonomy_id"),
        )
    )


# The registry's taxonomy, without the category promo.
REGISTRY_CATEGORIES = ["economy", "large", "medium", "small", "standard"]


def registry_taxonomy(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    ports = [(c, "home") for c in REGISTRY_CATEGORIES] + [(c, "hub") for c in REGISTRY_CATEGORIES[:3]]
    return (
        _rows(spark, [("tax", c, None) for c in REGISTRY_CATEGORIES], S.TAXONOMY_SCHEMA),
        _rows(spark, ports, S.TAXONOMY_PORTS_SCHEMA),
    )


def registry_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models with repeated ids; some have no category."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.lit("lib").alias("library_id"),
        key.alias("pos"),
        F.concat(F.lit("p"), F.floor(key / 2).cast("string")).alias("model_id"),
        F.when(size % 7 == 0, F.lit(None))
        .when(size % 6 == 0, "")
        .otherwise(F.lower("p_type"))
        .alias("taxonomy_category"),
    )


def catalog_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model for each brand and type: several in each category."""
    model = F.concat_ws("-", F.lower("p_brand"), F.lower("p_type"))
    return (
        table(spark, sf_dir, "part")
        .groupBy(model.alias("model_id"), F.lower("p_type").alias("taxonomy_category"))
        .agg(F.min("p_partkey").alias("pos"))
        .select(F.lit("lib").alias("library_id"), "pos", "model_id", "taxonomy_category")
    )


def requested_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(_named("p", "p_partkey").alias("model_id"))


def ticks_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of the event log: consecutive indexes, uneven steps."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("absolute_time_index"), F.lit("1").alias("block"), F.col("ts").alias("granular_date")
    )


def gapped_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar by order key: even steps, missing indexes."""
    key = F.col("o_orderkey")
    return (
        table(spark, sf_dir, "orders")
        .filter(key % 1000 != 7)
        .select(
            key.alias("absolute_time_index"),
            F.lit("1").alias("block"),
            F.expr("cast(date_add(date'1995-01-01', cast(o_orderkey as int)) as timestamp_ntz)").alias("granular_date"),
        )
    )


# Documents: one small nested document per row of a table, shaped as the readers shape them.


def _ids(*names: Column) -> Column:
    return F.array(*(F.struct(name.alias("id")) for name in names))


def taxonomy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def category(name: Column, ports: Column) -> Column:
        return F.struct(name.alias("id"), F.lit(None).cast("string").alias("parent-category"), ports.alias("ports"))

    none = F.lit(None).cast("array<struct<id: string>>")
    return table(spark, sf_dir, "part").select(
        _named("t", "p_partkey").alias("id"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_name")).alias("description"),
        F.array(
            category(F.lower("p_type"), _ids(F.lit("home"), F.col("p_brand"))), category(F.lit("bare"), none)
        ).alias("categories"),
    )


def library_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    def model(name: str, category: Column) -> Column:
        return F.struct(F.lit(name).alias("id"), category.alias("taxonomy-category"))

    return table(spark, sf_dir, "part").select(
        _named("l", "p_partkey").alias("id"),
        F.array(model("a", F.lower("p_type")), model("b", F.lit(None).cast("string"))).alias("models"),
    )


def system_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, none = _named("s", "s_suppkey"), F.lit(None).cast("string")
    model = F.concat(F.lit("lib.m"), (F.col("s_suppkey") % 4).cast("string"))
    return table(spark, sf_dir, "supplier").select(
        F.array(
            F.struct(name.alias("id"), model.alias("model")),
            F.struct(F.concat(name, F.lit("x")).alias("id"), none.alias("model")),
        ).alias("components"),
        F.array(
            F.struct(
                name.alias("component1"),
                F.lit("home").alias("port1"),
                _named("n", "s_nationkey").alias("component2"),
                none.alias("port2"),
            )
        ).alias("connections"),
    )


def catalog_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three definitions per catalog; for even sizes the third replaces the first."""
    size = F.col("p_size")
    ports = F.when(size % 3 == 1, "home").when(size % 3 == 2, '["home","hub"]')

    def term(output: Column) -> Column:
        return F.struct(
            F.lower("p_type").alias("taxonomy-category"), output.alias("output-id"), ports.alias("location-ports")
        )

    def metric(name: Column, operator: str, *outputs: Column) -> Column:
        return F.struct(
            name.alias("id"),
            F.array(*(term(o) for o in outputs)).alias("terms"),
            F.lit(operator).alias("terms-operator"),
            F.lit("sum").alias("time-operator"),
        )

    return table(spark, sf_dir, "part").select(
        _named("k", "p_partkey").alias("catalog_key"),
        F.col("p_brand").alias("id"),
        F.lit("tax").alias("taxonomy"),
        F.array(
            metric(F.lit("A"), "sum", F.lit("old")),
            metric(F.lit("B"), "avg", F.lit("first"), F.col("p_name")),
            metric(F.when(size % 2 == 0, "A").otherwise("C"), "avg", F.lit("new")),
        ).alias("metrics-definition"),
    )


def scoped_view_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views by order: scopes that give their values late, twice or not at all, known and unknown grains."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")

    def scope(category: Column, calendar: Column) -> Column:
        return F.struct(category.cast("string").alias("taxonomy-category"), calendar.cast("string").alias("calendar"))

    none = F.lit(None)
    return table(spark, sf_dir, "orders").select(
        _named("v", "o_orderkey").alias("id"),
        F.array(
            scope(none, F.when(key % 3 == 0, "")),
            scope(F.when(key % 5 != 0, status), F.when(key % 7 == 1, "early")),
            scope(F.lit("last"), F.when(key % 7 < 5, status)),
            scope(none, none),
        ).alias("all"),
        F.when(key % 4 != 0, F.array(F.struct(F.when(key % 11 == 0, "decade").otherwise("day").alias("time")))).alias(
            "aggregation"
        ),
        F.array(F.struct(F.concat(F.lit("c"), status).alias("id"))).alias("catalog"),
        (key % 6).alias("cut"),
    ).select("id", F.expr("if(cut = 0, slice(all, 1, 2), all)").alias("scope"), "aggregation", "catalog")


def view_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    first, second = F.concat(F.lit("c."), status), F.concat(_named("c", "o_custkey"), F.lit(".M"))
    return table(spark, sf_dir, "orders").select(_ids(first, second, first).alias("metrics"))
