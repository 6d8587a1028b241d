"""Column expressions shared by the operators."""

from panelworks.functions.moments import (
    common_pane,
    interval_micros,
    micros_of,
    name_stamp,
    rfc3339,
    seconds_of,
    truncated_to_millis,
    utc_instant,
    utc_naive,
)
from panelworks.functions.numeric import (
    clamp,
    is_finite,
    mean,
    min_max_score,
    plain_number,
    round_to,
    sum_parts,
    total,
    whole_sum,
)
from panelworks.functions.text import error_category, is_blank, label_of, lookup

__all__ = [
    "clamp",
    "common_pane",
    "error_category",
    "interval_micros",
    "is_blank",
    "is_finite",
    "label_of",
    "lookup",
    "mean",
    "micros_of",
    "min_max_score",
    "name_stamp",
    "plain_number",
    "rfc3339",
    "round_to",
    "seconds_of",
    "sum_parts",
    "total",
    "truncated_to_millis",
    "utc_instant",
    "utc_naive",
    "whole_sum",
]
