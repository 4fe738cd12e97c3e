"""A study: every table that one view is built from."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.sources import documents as docs
from viewloom.operators.checks import assert_clean
from viewloom.schemas import TIME_GRAINS
from viewloom.sources.calendar import read_calendar
from viewloom.sources.simulation import read_simulation
from viewloom.staging import file_system

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ViewConfig:
    """Scalars of the view document. The grain is carried; the calendar sets the dates."""

    id: str
    calendar_id: str
    location_category: str
    time_grain: str | None = None
    catalog_ids: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Study:
    """Lazy tables; see ``schemas`` for their columns."""

    simulation: DataFrame
    calendar: DataFrame
    taxonomy: DataFrame
    taxonomy_ports: DataFrame
    models: DataFrame
    components: DataFrame
    connections: DataFrame
    catalogs: DataFrame
    metrics: DataFrame
    terms: DataFrame
    references: DataFrame
    view: ViewConfig | None = None


def view_scalars(document: DataFrame) -> DataFrame:
    """(id, category, calendar, grain, catalogs) of view documents: the first that are given of each."""

    def first_given(name: str):
        given = F.filter("scope", lambda s: s[name].isNotNull() & (s[name] != ""))
        return F.try_element_at(given, F.lit(1))[name]

    return document.select(
        "id",
        first_given("taxonomy-category").alias("category"),
        first_given("calendar").alias("calendar"),
        F.try_element_at("aggregation", F.lit(1))["time"].alias("grain"),
        F.transform("catalog", lambda c: c["id"]).alias("catalogs"),
    )


def view_violations(document: DataFrame) -> DataFrame:
    """(rule, subject, detail): a view that names no category or calendar, or an unknown grain."""
    given = lambda name: F.exists("scope", lambda s: s[name].isNotNull() & (s[name] != ""))
    grain = F.try_element_at("aggregation", F.lit(1))["time"]
    contract = [
        ("scope_category", F.coalesce(given("taxonomy-category"), F.lit(False)), F.lit("")),
        ("scope_calendar", F.coalesce(given("calendar"), F.lit(False)), F.lit("")),
        ("time_grain", grain.isNull() | grain.isin(*TIME_GRAINS), F.coalesce(grain, F.lit(""))),
    ]
    rules = F.array(
        *(F.struct(F.lit(r).alias("rule"), h.alias("holds"), d.alias("detail")) for r, h, d in contract)
    )
    broken = document.select("id", F.explode(rules).alias("r")).filter("NOT r.holds")
    return broken.select("r.rule", F.col("id").alias("subject"), "r.detail")


def read_view_config(document: DataFrame) -> ViewConfig:
    """Scalars of a view document: the first category, calendar and grain that are given."""

    assert_clean(view_violations(document))
    row = view_scalars(document).first()
    return ViewConfig(row["id"], row["calendar"], row["category"], row["grain"], list(row["catalogs"] or []))


def read_catalogs(spark: SparkSession, path: str, catalog_ids: list[str]) -> DataFrame:
    """Catalog documents under the ids of their files, which is what references name."""
    if not catalog_ids:
        raise ValueError("The view names no catalog")
    paths = [f"{path}/{key}.json" for key in dict.fromkeys(catalog_ids)]
    return docs.read_documents(spark, paths, docs.CATALOG_DOCUMENT, "catalog_key")


def simulation_path(spark: SparkSession, path: str) -> str:
    """The study's one simulation table; several or none make no study."""
    files, where = file_system(spark, f"{path}/simulation_table*.parquet")
    found = sorted(str(match.getPath()) for match in files.globStatus(where) or [])
    if len(found) != 1:
        raise ValueError(f"simulation_table: {path} has {len(found)} tables, not one: {', '.join(found)}")
    return found[0]


def load_study(
    spark: SparkSession,
    path: str,
    components: DataFrame | None = None,
    connections: DataFrame | None = None,
) -> Study:
    """Study directory -> lazy tables. Only documents and the calendar are read here.

    Documents are ``view_config``, ``taxonomy``, ``library``, ``system`` and
    ``catalogs/<id>``, all ``.json``; the calendar is ``<calendar id>.csv`` and the fact
    table the one ``simulation_table*.parquet``. A large system document is read in several
    tasks; a system may also come as tables: pass ``components`` and ``connections`` and
    ``system`` is not read.
    """
    path = path.rstrip("/")
    view_document = docs.read_document(spark, f"{path}/view_config.json", docs.VIEW_DOCUMENT)
    view = read_view_config(view_document)
    taxonomy, taxonomy_ports = docs.taxonomy_tables(
        docs.read_document(spark, f"{path}/taxonomy.json", docs.TAXONOMY_DOCUMENT)
    )
    if components is None or connections is None:
        read_components, read_connections = docs.read_system(spark, f"{path}/system.json")
        components = read_components if components is None else components
        connections = read_connections if connections is None else connections
    catalogs, metrics, terms = docs.catalog_tables(
        read_catalogs(spark, f"{path}/catalogs", view.catalog_ids)
    )
    calendar = read_calendar(spark, f"{path}/{view.calendar_id}.csv")
    study = Study(
        simulation=read_simulation(spark, simulation_path(spark, path)),
        calendar=calendar,
        taxonomy=taxonomy,
        taxonomy_ports=taxonomy_ports,
        models=docs.model_table(docs.read_document(spark, f"{path}/library.json", docs.LIBRARY_DOCUMENT)),
        components=components,
        connections=connections,
        catalogs=catalogs,
        metrics=metrics,
        terms=terms,
        references=docs.reference_table(view_document),
        view=view,
    )
    log.info("Study loaded from %s", path)
    return study
