"""Indicator-panel analytics on PySpark."""

from panelworks.operators.aggregate import (
    average_since,
    dynamics,
    group_stats,
    histogram,
    kpi_mean,
    kpi_negative,
    kpi_total,
    median_stats,
    top_means,
)
from panelworks.operators.clean import clean, clean_report, keep_first
from panelworks.operators.reports import fetch, fetch_group_stats, panel_filter, top_scored
from panelworks.operators.shape import assign_shards, clamp_round, coverage, gaps, residuals
from panelworks.operators.validate import rejected_rows, valid_rows, validate
from panelworks.operators.validate_json import validate_json
from panelworks.operators.windows import (
    count_windows,
    hybrid_windows,
    sliding_means,
    top_per_window,
    trailing,
    tumbling,
)
from panelworks.schema import DEMOGRAPHIC_RULES, FilterSpec, PanelSpec, Range, RuleSet
from panelworks.session import tuned
from panelworks.sources.ndjson import load_raw, scan_lenient

__all__ = [
    "DEMOGRAPHIC_RULES",
    "FilterSpec",
    "PanelSpec",
    "Range",
    "RuleSet",
    "assign_shards",
    "average_since",
    "clamp_round",
    "clean",
    "clean_report",
    "count_windows",
    "coverage",
    "dynamics",
    "fetch",
    "fetch_group_stats",
    "gaps",
    "group_stats",
    "histogram",
    "hybrid_windows",
    "keep_first",
    "kpi_mean",
    "kpi_negative",
    "kpi_total",
    "load_raw",
    "median_stats",
    "panel_filter",
    "rejected_rows",
    "residuals",
    "scan_lenient",
    "sliding_means",
    "top_means",
    "top_per_window",
    "top_scored",
    "trailing",
    "tumbling",
    "tuned",
    "valid_rows",
    "validate",
    "validate_json",
]
