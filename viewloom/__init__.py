"""Metric views over simulation tables, on Spark."""

from viewloom.operators.aggregate import aggregate_terms, aggregate_time
from viewloom.operators.calendar import calendar_violations, filter_by_calendar, rows_in_calendar
from viewloom.operators.joins import Limits
from viewloom.operators.locating import locate, peer_violations, port_edges
from viewloom.operators.references import get_metric, metric_references
from viewloom.operators.structure import (
    components_by_model,
    instances_of_model,
    metric_structure,
    models_by_category,
    models_in_category,
)
from viewloom.plans.view import build_view, run, selected_metrics, study_structure, validate_study
from viewloom.sources import (
    Study,
    append_view,
    load_study,
    read_calendar,
    read_simulation,
    read_view,
    write_filtered,
    write_granular,
    write_structure,
    write_view,
)

__all__ = [
    "Limits",
    "Study",
    "aggregate_terms",
    "aggregate_time",
    "append_view",
    "build_view",
    "calendar_violations",
    "components_by_model",
    "filter_by_calendar",
    "get_metric",
    "instances_of_model",
    "load_study",
    "locate",
    "metric_references",
    "metric_structure",
    "models_by_category",
    "models_in_category",
    "peer_violations",
    "port_edges",
    "read_calendar",
    "read_simulation",
    "read_view",
    "rows_in_calendar",
    "run",
    "selected_metrics",
    "study_structure",
    "validate_study",
    "write_filtered",
    "write_granular",
    "write_structure",
    "write_view",
]
