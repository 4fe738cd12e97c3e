"""Readers of studies and simulation tables, writers of views."""

from viewloom.sources.calendar import read_calendar
from viewloom.sources.simulation import read_simulation
from viewloom.sources.study import Study, load_study
from viewloom.sources.views import append_view, read_view, write_filtered, write_granular, write_structure, write_view

__all__ = [
    "Study",
    "append_view",
    "load_study",
    "read_calendar",
    "read_simulation",
    "read_view",
    "write_filtered",
    "write_granular",
    "write_structure",
    "write_view",
]
