"""Dashboard run: one filtered panel, all report frames over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from panelworks.operators import aggregate, reports
from panelworks.schema import PanelSpec


def dashboard(
    panel: DataFrame,
    indicator: str,
    years: tuple[int, int],
    groups: Sequence[str],
    slice_year: int,
    spec: PanelSpec = PanelSpec(),
    kpi_indicators: tuple[str, str, str] = ("population", "life_expectancy", "natural_growth"),
) -> dict[str, DataFrame]:
    """KPIs, dynamics, year slice and scored table of one filter setting.

    The frames share the filter, not a cache: on a panel stored by indicator each
    of them prunes to the folders and columns it needs.
    """
    part = reports.panel_filter(panel, years, groups, spec)
    summed, averaged, counted = kpi_indicators
    return {
        "kpi_total": aggregate.kpi_total(part, summed, spec=spec),
        "kpi_mean": aggregate.kpi_mean(part, averaged, spec),
        "kpi_negative": aggregate.kpi_negative(part, counted, spec),
        "dynamics": aggregate.dynamics(part, indicator, spec),
        "year_slice": reports.year_slice(part, indicator, slice_year, spec),
        "top_scored": reports.top_scored(part, indicator, slice_year, spec=spec),
        "top_stats": reports.top_stats(part, indicator, slice_year, spec=spec),
    }
