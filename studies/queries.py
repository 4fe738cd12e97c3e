"""One query per operator, over the studies' whole tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import viewloom as vl
from studies import tables as t
from studies.files import file_filtered, file_simulation, file_system_components, file_system_edges, file_view
from viewloom.operators import checks
from viewloom.operators.calendar import constant_rows as rows_without_time
from viewloom.operators.calendar import date_steps as steps_of
from viewloom.operators.references import (
    judged_references,
    latest_definitions,
    parse_references,
    resolve_references,
)
from viewloom.operators.references import skipped_references as find_skipped
from viewloom.operators.structure import model_terms
from viewloom.schemas import GRANULAR_COLUMNS, VIEW_COLUMNS
from viewloom.sources import documents as docs
from viewloom.sources.study import view_scalars, view_violations
from viewloom.staging import new_folder

DIGITS = 6  # engines add in different orders; results are compared to this many decimals


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, DIGITS))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{new_folder(spark, 'results')}/{name}"


def _lineitem_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vl.filter_by_calendar(t.lineitem_simulation(spark, sf_dir), t.lineitem_calendar(spark))


def filter_by_calendar(spark, sf_dir):
    return _lineitem_filtered(spark, sf_dir)


def filter_by_calendar_hourly(spark, sf_dir):
    return vl.filter_by_calendar(t.events_simulation(spark, sf_dir), t.events_calendar(spark))


def constant_rows(spark, sf_dir):
    return rows_without_time(t.events_simulation(spark, sf_dir)).select("component", "output", "block", "value")


def calendar_semi_check(spark, sf_dir):
    """Per output: filtered rows with a time index, and those of them that are in the calendar."""
    filtered = _lineitem_filtered(spark, sf_dir)
    timed = filtered.filter(F.col("absolute_time_index").isNotNull()).groupBy("output").agg(F.count("*").alias("timed"))
    inside = vl.rows_in_calendar(filtered, t.lineitem_calendar(spark)).groupBy("output").agg(
        F.count("*").alias("in_calendar")
    )
    return timed.join(inside, "output", "left").select("output", "timed", "in_calendar")


def calendar_violations(spark, sf_dir):
    return vl.calendar_violations(t.ticks_calendar(spark, sf_dir))


def calendar_violations_gaps(spark, sf_dir):
    return vl.calendar_violations(t.gapped_calendar(spark, sf_dir))


def date_steps(spark, sf_dir):
    seconds = F.col("step").cast("interval second").cast("decimal(18,6)")
    return steps_of(t.ticks_calendar(spark, sf_dir)).select(
        "absolute_time_index", (seconds * 1_000_000).cast("long").alias("step_us")
    )


def port_edges(spark, sf_dir):
    return vl.port_edges(t.lineitem_connections(spark, sf_dir))


def peer_cardinality(spark, sf_dir):
    """Of every component's home, hub and aux port: those without exactly one peer."""
    needed = t.lineitem_components(spark, sf_dir).select(
        "component", F.explode(F.array(F.lit("home"), F.lit("hub"), F.lit("aux"))).alias("port")
    )
    return vl.peer_violations(needed, t.lineitem_connections(spark, sf_dir))


def components_by_model(spark, sf_dir):
    return vl.components_by_model(t.lineitem_components(spark, sf_dir))


def models_by_category(spark, sf_dir):
    return vl.models_by_category(t.registry_models(spark, sf_dir))


def model_violations(spark, sf_dir):
    """Requested models that the library lacks, or that have no category; the library lacks a tenth."""
    library = t.registry_models(spark, sf_dir).filter("pos % 10 <> 3")
    return checks.model_violations(t.requested_models(spark, sf_dir), library)


def column_violations(spark, sf_dir):
    """Tables that break their contracts: a column missing, one too many, two swapped; with each table's rows."""
    simulation = t.lineitem_simulation(spark, sf_dir)
    swapped = t.ticks_calendar(spark, sf_dir).select("block", "absolute_time_index", "granular_date")
    broken = [
        (simulation.drop("value").withColumn("unit", F.lit("MW")), checks.simulation_column_violations),
        (swapped, lambda calendar: checks.calendar_column_violations(spark, calendar.columns)),
        (simulation.withColumn("date", F.lit(None).cast("date")), checks.filtered_column_violations),
    ]
    found = []
    for table, check in broken:
        violations = check(table)
        subject = violations.first()["subject"]
        rows = table.groupBy(F.lit(subject).alias("subject")).agg(F.count("*").alias("rows"))
        found.append(violations.join(rows, "subject").select("rule", "subject", "detail", "rows"))
    return reduce(DataFrame.unionByName, found)


def metric_refs(spark, sf_dir):
    return vl.metric_references(t.registry_references(spark, sf_dir))


def latest_metric_definition(spark, sf_dir):
    return latest_definitions(t.registry_definitions(spark, sf_dir), ["catalog_key", "metric_id"], "pos")


def reference_problems(spark, sf_dir):
    """Every reference with its metric's latest operators, or why it cannot be built."""
    return judged_references(
        t.registry_references(spark, sf_dir),
        t.registry_catalogs(spark, sf_dir),
        latest_metric_definition(spark, sf_dir).drop("pos"),
    )


def skipped_references(spark, sf_dir):
    """References to metrics that their catalog does not define, all of them."""
    return find_skipped(
        t.registry_references(spark, sf_dir),
        t.registry_catalogs(spark, sf_dir),
        latest_metric_definition(spark, sf_dir).drop("pos"),
    )


def time_operator_violations(spark, sf_dir):
    references = parse_references(t.registry_references(spark, sf_dir))
    return checks.time_operator_violations(resolve_references(references, latest_metric_definition(spark, sf_dir)))


def catalog_violations(spark, sf_dir):
    taxonomy, ports = t.registry_taxonomy(spark)
    return checks.catalog_violations(
        t.registry_catalogs(spark, sf_dir), t.registry_terms(spark, sf_dir), taxonomy, ports, "tax"
    )


def definition_violations(spark, sf_dir):
    return checks.definition_violations(t.registry_definitions(spark, sf_dir), t.registry_terms(spark, sf_dir))


def metric_structure(spark, sf_dir):
    """Structure of every reference of the lineitem study."""
    study = t.lineitem_study(spark, sf_dir)
    references = parse_references(study.references)
    return vl.study_structure(study).join(references, ["catalog_key", "metric_id"]).select(
        "pos",
        "metric_id",
        "component",
        "metric_location",
        "breakdown_properties",
        "output",
        "weight_output_id",
        "copies",
    )


def _terms(spark, sf_dir, operator) -> DataFrame:
    structure = vl.study_structure(t.lineitem_study(spark, sf_dir))
    chosen = structure.filter(F.col("terms_operator") == operator) if operator else structure
    return vl.aggregate_terms(_lineitem_filtered(spark, sf_dir), chosen)


def terms_sum(spark, sf_dir):
    return _rounded(_terms(spark, sf_dir, "sum"), "granular_metric_value").select("catalog_key", *GRANULAR_COLUMNS)


def terms_avg(spark, sf_dir):
    return _rounded(_terms(spark, sf_dir, "avg"), "granular_metric_value").select("catalog_key", *GRANULAR_COLUMNS)


def time_sum(spark, sf_dir):
    return _rounded(vl.aggregate_time(_terms(spark, sf_dir, None)), "metric_value").select("catalog_key", *VIEW_COLUMNS)


def unmatched_structure(spark, sf_dir):
    """A metric whose output no row of the table has: one zero row per location."""
    study = t.lineitem_study(spark, sf_dir)
    return vl.build_view(replace(study, references=study.references.filter("reference = 'c1.GHOST'")))


def build_view(spark, sf_dir):
    return _rounded(vl.build_view(t.lineitem_study(spark, sf_dir)), "metric_value")


def build_view_events(spark, sf_dir):
    return _rounded(vl.build_view(t.events_study(spark, sf_dir)), "metric_value")


def view_round_trip(spark, sf_dir):
    """Validate, build, write and read back."""
    written = vl.run(t.lineitem_study(spark, sf_dir), _scratch(spark, "results"))
    return _rounded(written, "metric_value")


def filtered_round_trip(spark, sf_dir):
    return vl.write_filtered(filter_by_calendar_hourly(spark, sf_dir), _scratch(spark, "filtered"))


def structure_round_trip(spark, sf_dir):
    return vl.write_structure(metric_structure(spark, sf_dir), _scratch(spark, "structure"))


def granular_round_trip(spark, sf_dir):
    study = t.events_study(spark, sf_dir)
    filtered = vl.filter_by_calendar(study.simulation, study.calendar)
    written = vl.write_granular(vl.aggregate_terms(filtered, vl.study_structure(study)), _scratch(spark, "granular"))
    return _rounded(written, "granular_metric_value")


def view_append(spark, sf_dir):
    """A view, then the same view appended to it."""
    view = vl.build_view(t.events_study(spark, sf_dir))
    path = vl.write_view(view, _scratch(spark, "results"))
    vl.append_view(view, path)
    return _rounded(vl.read_view(spark, path), "metric_value")


def view_append_by_run(spark, sf_dir):
    """A view kept by run: two runs, of which the second is appended twice and counts once."""
    study = t.events_study(spark, sf_dir)
    view = vl.build_view(study)
    path = vl.write_view(view, _scratch(spark, "results"), run="first")
    for _ in range(2):
        vl.append_view(view, path, run="second")
    return _rounded(vl.read_view(spark, path), "metric_value")


def located_components(spark, sf_dir):
    """Every qualified component by itself, by one port and by three ports, in no alphabetical order."""
    ports = F.array(
        F.lit(None).cast("array<string>"),
        F.array(F.lit("home")),
        F.array(F.lit("hub"), F.lit("home"), F.lit("aux")),
        F.array(F.lit("hub"), F.lit("home"), F.lit("hub")),
    )
    rows = vl.components_by_model(t.lineitem_components(spark, sf_dir)).select(
        "component", F.posexplode(ports).alias("case", "location_ports")
    )
    located = vl.locate(rows, ["component", "case"], t.lineitem_connections(spark, sf_dir))
    return located.select("component", "case", "metric_location", "location_problem")


def selected_metrics(spark, sf_dir):
    """References joined with the latest definitions, per metric."""
    references = parse_references(t.registry_references(spark, sf_dir))
    return vl.selected_metrics(resolve_references(references, latest_metric_definition(spark, sf_dir)))


def terms_with_models(spark, sf_dir):
    """Terms of all registry metrics with a qualified model of their category."""
    terms = t.registry_terms(spark, sf_dir)
    metrics = terms.select("catalog_key", "metric_id", F.lit("sum").alias("terms_operator"))
    models = t.catalog_models(spark, sf_dir)
    return model_terms(metrics, terms, models).select("catalog_key", "metric_id", "taxonomy_category", "model_ref")


def taxonomy_categories(spark, sf_dir):
    return docs.taxonomy_tables(t.taxonomy_documents(spark, sf_dir))[0]


def taxonomy_ports(spark, sf_dir):
    return docs.taxonomy_tables(t.taxonomy_documents(spark, sf_dir))[1]


def document_headers(spark, sf_dir):
    return docs.headers(t.taxonomy_documents(spark, sf_dir))


def library_models(spark, sf_dir):
    documents = t.library_documents(spark, sf_dir)
    return docs.model_table(documents)


def system_components(spark, sf_dir):
    return docs.system_tables(t.system_documents(spark, sf_dir))[0]


def system_connections(spark, sf_dir):
    return docs.system_tables(t.system_documents(spark, sf_dir))[1]


def catalog_metrics(spark, sf_dir):
    return docs.catalog_tables(t.catalog_documents(spark, sf_dir))[1]


def catalog_terms(spark, sf_dir):
    terms = docs.catalog_tables(t.catalog_documents(spark, sf_dir))[2]
    return terms.withColumn("location_ports", F.concat_ws(",", "location_ports"))


def view_references(spark, sf_dir):
    return docs.reference_table(t.view_documents(spark, sf_dir))


def view_scopes(spark, sf_dir):
    """The first category, calendar and grain that each view gives."""
    scalars = view_scalars(t.scoped_view_documents(spark, sf_dir))
    return scalars.withColumn("catalogs", F.concat_ws(",", "catalogs"))


def view_scope_violations(spark, sf_dir):
    return view_violations(t.scoped_view_documents(spark, sf_dir))


QUERIES = {
    query.__name__: query
    for query in (
        filter_by_calendar,
        filter_by_calendar_hourly,
        constant_rows,
        calendar_semi_check,
        calendar_violations,
        calendar_violations_gaps,
        date_steps,
        port_edges,
        peer_cardinality,
        components_by_model,
        models_by_category,
        model_violations,
        metric_refs,
        latest_metric_definition,
        reference_problems,
        skipped_references,
        time_operator_violations,
        catalog_violations,
        definition_violations,
        column_violations,
        metric_structure,
        terms_sum,
        terms_avg,
        time_sum,
        unmatched_structure,
        build_view,
        build_view_events,
        view_round_trip,
        filtered_round_trip,
        structure_round_trip,
        granular_round_trip,
        view_append,
        view_append_by_run,
        located_components,
        selected_metrics,
        terms_with_models,
        taxonomy_categories,
        taxonomy_ports,
        document_headers,
        library_models,
        system_components,
        system_connections,
        catalog_metrics,
        catalog_terms,
        view_references,
        view_scopes,
        view_scope_violations,
        file_simulation,
        file_filtered,
        file_view,
        file_system_components,
        file_system_edges,
    )
}
