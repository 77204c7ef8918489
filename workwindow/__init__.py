"""Workable-hours analytics for many sites, expressed as Spark DataFrame plans."""

from workwindow.operators.classify import (
    classify,
    classify_by_site_rules,
    evaluate_thresholds,
    evaluation_summary,
    operational_mask,
)
from workwindow.plans.bundle import Bundle, build_bundle
from workwindow.rules.runwide import RuleSet
from workwindow.session import build_session

__all__ = [
    "Bundle",
    "RuleSet",
    "build_bundle",
    "build_session",
    "classify",
    "classify_by_site_rules",
    "evaluate_thresholds",
    "evaluation_summary",
    "operational_mask",
]
