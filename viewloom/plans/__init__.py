"""Whole-study plans."""

from viewloom.plans.view import build_view, run, selected_metrics, validate_study

__all__ = ["build_view", "run", "selected_metrics", "validate_study"]
