"""Text and array expressions over metadata columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_wellformed_reference(reference: Column) -> Column:
    """True for ``<catalog>.<metric>``: a dot that is neither the first nor the last character."""
    wellformed = reference.contains(".") & ~reference.startswith(".") & ~reference.endswith(".")
    return F.coalesce(wellformed, F.lit(False))


def reference_catalog(reference: Column) -> Column:
    """Catalog part of a reference: everything before the first dot."""
    return F.split(reference, "[.]", 2)[0]


def reference_metric(reference: Column) -> Column:
    """Metric part of a reference: everything after the first dot, which may hold more dots."""
    return F.try_element_at(F.split(reference, "[.]", 2), F.lit(2))


def qualified_model(library_id: Column, model_id: Column) -> Column:
    """``<library>.<model>``, the form in which components name their model."""
    return F.concat_ws(".", library_id, model_id)


def second_port(port1: Column, port2: Column) -> Column:
    """Port on the far side of a connection; it defaults to the near side's port."""
    return F.coalesce(port2, port1)


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def join_peers(peers: Column) -> Column:
    """``a|b|c`` from an array of peers, in its order."""
    return F.array_join(peers, "|")


def parse_ports(raw: Column) -> Column:
    """Port list of a term whose document field is null, one port or a JSON list of ports."""
    return (
        F.when(raw.isNull(), F.lit(None).cast("array<string>"))
        .when(raw.startswith("["), F.from_json(raw, "array<string>"))
        .otherwise(F.array(raw))
    )
