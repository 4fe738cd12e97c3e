"""From a study to its view, in one plan for all metrics."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewloom.operators import checks
from viewloom.operators.aggregate import (
    METRIC_GROUP,
    group_table,
    masked_links,
    terms_values,
    time_values,
    unmasked_links,
    view_values,
)
from viewloom.operators.calendar import calendar_violations, filter_by_calendar, summarise_calendar
from viewloom.operators.joins import DEFAULT_LIMITS, Limits, row_bytes
from viewloom.operators.references import judged_references, parse_references, resolve_references
from viewloom.operators.structure import METRIC_KEYS, metric_structure
from viewloom.schemas import VIEW_COLUMNS
from viewloom.sources.study import Study
from viewloom.sources.views import read_view, write_view
from viewloom.staging import released, stage_measured

log = logging.getLogger(__name__)

#: The exact list of outputs is a scan predicate up to so many bytes, and so many outputs; their range always is one.
PUSHED_BYTES, PUSHED_OUTPUTS = 1 << 20, 1 << 14
REFERENCE_ERRORS = {
    "reference_format": (ValueError, "reference_format: '{reference}' is not '<catalog_id>.<metric_id>'"),
    "unknown_catalog": (KeyError, "unknown_catalog: '{reference}' names a catalog that the view does not list"),
    "terms_operator": (
        ValueError,
        "terms_operator: {reference} asks for {terms_operator}, only sum and avg are supported",
    ),
    "time_operator": (
        NotImplementedError,
        "time_operator: {reference} asks for {time_operator}, only sum is supported",
    ),
}


def validate_study(study: Study) -> None:
    """All checks that need metadata and calendar only; run before any heavy work."""
    checks.assert_clean(checks.simulation_column_violations(study.simulation))
    checks.assert_clean(checks.calendar_column_violations(study.calendar.sparkSession, study.calendar.columns))
    taxonomy_ids = study.taxonomy.select("taxonomy_id").distinct().limit(2).collect()
    if len(taxonomy_ids) != 1:
        raise ValueError("The study needs exactly one taxonomy")
    checks.assert_clean(
        checks.reference_violations(study.references)
        .unionByName(calendar_violations(study.calendar))
        .unionByName(checks.definition_violations(study.metrics, study.terms))
        .unionByName(
            checks.catalog_violations(
                study.catalogs, study.terms, study.taxonomy, study.taxonomy_ports, taxonomy_ids[0][0]
            )
        )
    )


def _usable_references(study: Study) -> DataFrame:
    """References that the view is built from. Raises for malformed ones, unknown catalogs and
    unsupported operators; logs how many name unknown metrics and skips them
    (``skipped_references`` returns all of these)."""
    judged = judged_references(study.references, study.catalogs, study.metrics)
    kinds = {name: F.count_if(F.col("problem") == name) for name in (*REFERENCE_ERRORS, "unknown_metric")}
    judged, found = stage_measured(judged, "references", **kinds)
    if not any(found.values()):
        return judged
    first = F.min_by(F.struct("reference", "terms_operator", "time_operator"), "pos").alias("first")
    problems = judged.groupBy("problem").agg(F.count("*").alias("n"), F.min("pos").alias("pos"), first).collect()
    faults = [row for row in problems if row["problem"] in REFERENCE_ERRORS]
    if faults:
        row = min(faults, key=lambda r: r["pos"])
        error, message = REFERENCE_ERRORS[row["problem"]]
        raise error(message.format(**row["first"].asDict()) + f" ({row['n']} references in all)")
    for row in problems:
        if row["problem"] == "unknown_metric":
            log.warning("%s references are skipped, %s first: no definition", row["n"], row["first"]["reference"])
    return judged.filter(F.col("problem").isNull())


def selected_metrics(references: DataFrame) -> DataFrame:
    """Distinct metrics of resolved references, with how often each is referenced."""
    return references.groupBy(*METRIC_KEYS, "terms_operator").agg(F.count(F.lit(1)).alias("mentions"))


def study_structure(study: Study) -> DataFrame:
    """Structure of all metrics that the view references and a catalog defines."""
    resolved = resolve_references(parse_references(study.references), study.metrics)
    return metric_structure(
        selected_metrics(resolved), study.terms, study.models, study.components, study.connections
    )


def build_view(study: Study, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """The view of all references.

    What runs here: judging references, resolving, staging the structure and its groups, and the
    one pass over the fact table, whose aggregated result is staged. The rest runs when the
    view is read.

    The structure is checked, and measured by the job that writes it. The fact table is then read
    with the calendar's index range and the metrics' outputs as scan predicates, and aggregated
    with one shuffle for all metrics.

    * A metric referenced twice is aggregated once; its rows repeat at the end.
    * Rows are grouped by a fingerprint of (catalog, metric, location) instead of those
      texts, which are joined to the result, by broadcast if they fit. If fingerprints
      collide, rows are grouped by the texts.
    * Time aggregation folds into terms aggregation where the calendar has one index per
      date, or no metric takes a mean.
    """
    structure = metric_structure(
        selected_metrics(_usable_references(study)),
        study.terms,
        study.models,
        study.components,
        study.connections,
    )
    structure = structure.withColumn("group_id", F.xxhash64(*METRIC_GROUP))
    structure = structure.withColumn("_link", F.monotonically_increasing_id())
    structure, measured = stage_measured(structure, "structure", **_measures(structure))
    if measured["problems"]:
        checks.assert_clean(checks.location_violations(structure))

    summary = summarise_calendar(study.calendar)
    simulation = study.simulation
    if measured["first_output"] is not None:
        simulation = simulation.filter(F.col("output").between(measured["first_output"], measured["last_output"]))
    outputs = structure.select("output").distinct().limit(PUSHED_OUTPUTS + 1).collect()
    if len(outputs) <= PUSHED_OUTPUTS and len(outputs) * measured["output_bytes"] <= PUSHED_BYTES:
        simulation = simulation.filter(F.col("output").isin([row["output"] for row in outputs]))
    filtered = filter_by_calendar(simulation, study.calendar, limits, summary)

    labels = [*METRIC_GROUP, "mentions"]
    groups, kinds = group_table(structure, "group_id", labels)
    is_avg = F.col("terms_operator") == "avg" if measured["means"] else F.lit(False)  # a literal leaves the key
    links = structure.select("_link", "component", "output", "group_id", *labels, is_avg.alias("is_avg"), "copies")
    small = measured["link_bytes"] <= limits.broadcast_bytes
    if kinds["clashes"]:
        links = unmasked_links(links.drop("group_id"), labels, small=None)
    else:
        links = masked_links(links.drop(*labels), "group_id", groups, kinds, small)
    if summary.one_index_per_date or not measured["means"]:
        view = view_values(filtered, links, limits)
    else:
        view = time_values(terms_values(filtered, links, limits), links.keys)
    if not kinds["clashes"]:
        few = kinds["bytes"] <= limits.broadcast_bytes
        view = view.join(F.broadcast(groups) if few else groups.hint("merge"), "group_id")
    if (measured["mentions"] or 1) > 1:
        view = view.withColumn("_mention", F.explode(F.sequence(F.lit(1), F.col("mentions"))))
    return view.select(*VIEW_COLUMNS)


def _measures(structure: DataFrame) -> dict[str, Column]:
    """Sizes and kinds of the structure, aggregated while it is staged."""
    link = structure.select("component", "output", "group_id", "terms_operator", "copies", "_link")
    return {
        "link_bytes": F.coalesce(F.sum(row_bytes(link) + 16), F.lit(0)),  # its mask comes later
        "problems": F.count("location_problem"),
        "means": F.count_if(F.col("terms_operator") == "avg"),
        "mentions": F.max("mentions"),
        "first_output": F.min("output"),
        "last_output": F.max("output"),
        "output_bytes": F.coalesce(F.max(F.octet_length("output")), F.lit(0)),
    }


def run(study: Study, results: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Validate, build, write; returns the re-opened view."""
    spark = study.simulation.sparkSession
    validate_study(study)
    with released(spark):
        path = write_view(build_view(study, limits), results)
    log.info("View written to %s", path)
    return read_view(spark, path)
