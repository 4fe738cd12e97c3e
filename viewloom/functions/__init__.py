"""Column expressions shared by the operators. All of them stay JVM-side."""

from viewloom.functions.aggregates import terms_value, zero_sum
from viewloom.functions.text import (
    is_wellformed_reference,
    join_peers,
    or_empty,
    parse_ports,
    qualified_model,
    reference_catalog,
    reference_metric,
    second_port,
)

__all__ = [
    "is_wellformed_reference",
    "join_peers",
    "or_empty",
    "parse_ports",
    "terms_value",
    "qualified_model",
    "reference_catalog",
    "reference_metric",
    "second_port",
    "zero_sum",
]
