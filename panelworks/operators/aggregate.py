"""Grouped statistics, latest-year indicators, histogram, extent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.functions import mean, round_to, total
from panelworks.operators import ranking
from panelworks.schema import PanelSpec
from panelworks.session import stored, stored_counted


def group_stats(
    df: DataFrame, by: Sequence[str], spec: PanelSpec = PanelSpec(), digits: int = 2
) -> DataFrame:
    """sum, avg (rounded), min, max and count per group, sorted by the group columns.

    A null group value forms a group of its own.
    """
    value = F.col(spec.value)
    return (
        df.groupBy(*by)
        .agg(
            total(value, spec.scale).alias("sum"),
            round_to(mean(value, spec.scale), digits).alias("avg"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.count(F.lit(1)).alias("count"),
        )
        .orderBy(*by)
    )


def bounded_stats(
    df: DataFrame, by: Sequence[str], spec: PanelSpec = PanelSpec(), digits: int = 2
) -> DataFrame:
    """Statistics with the exact median for groups whose size is bounded already."""
    value = F.col(spec.value)
    return df.groupBy(*by).agg(
        round_to(total(value, spec.scale), digits).alias("sum"),
        round_to(mean(value, spec.scale), digits).alias("avg"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.count(F.lit(1)).alias("count"),
        round_to(F.percentile(value, 0.5), digits).alias("p50"),
    )


def median_stats(
    df: DataFrame,
    by: Sequence[str],
    spec: PanelSpec = PanelSpec(),
    digits: int = 2,
    heavy_rows: int = ranking.HEAVY_ROWS,
) -> DataFrame:
    """sum, avg, min, max, count and exact median p50 per group of any size.

    Rows are folded into value runs map-side, in one scan; everything else is
    taken from the runs.
    """
    return run_stats(ranking.value_runs(df, by, spec.value), by, "n", spec, digits, heavy_rows)


def _run_totals(spec: PanelSpec, count: str, median: Column, digits: int) -> list[Column]:
    value, n = F.col(spec.value), F.col(count)
    added = total(value, spec.scale, n)
    present = F.sum(F.when(value.isNotNull(), n)).cast("double")
    return [
        round_to(added, digits).alias("sum"),
        round_to(F.try_divide(added, present), digits).alias("avg"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.sum(n).alias("count"),
        median,
    ]


def run_stats(
    runs: DataFrame,
    by: Sequence[str],
    count: str = "n",
    spec: PanelSpec = PanelSpec(),
    digits: int = 2,
    heavy_rows: int = ranking.HEAVY_ROWS,
) -> DataFrame:
    """:func:`median_stats` of rows that were already folded into value runs.

    ``percentile`` keeps the distinct values of a group in memory.  The runs are stored
    first; groups with too many of them get their median by radix selection, all other
    statistics combine map-side anyway.
    """
    runs, held = stored_counted(runs, "runs")

    def weighted(part: DataFrame) -> DataFrame:
        median = F.percentile(F.col(spec.value), 0.5, F.col(count))
        return part.groupBy(*by).agg(
            *_run_totals(spec, count, round_to(median, digits).alias("p50"), digits)
        )

    if held <= heavy_rows:  # no group can have more
        return weighted(runs)
    heavy = ranking.heavy_groups(runs, by, heavy_rows)
    if heavy.isEmpty():
        return weighted(runs)
    heavy = stored(heavy, "heavy")
    light, hot = ranking.split_heavy(runs, by, heavy)
    medians = ranking.heavy_median(hot, by, spec.value, count, "_p50")
    totals = hot.groupBy(*by).agg(*_run_totals(spec, count, F.lit(None).alias("p50"), digits))
    hot_stats = ranking.join_groups(totals, medians, by, "left").select(
        *by, "sum", "avg", "min", "max", "count", round_to(F.col("_p50"), digits).alias("p50")
    )
    return weighted(light).unionByName(hot_stats)


def average_since(
    df: DataFrame, since: int, limit: int = 20, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Average and row count by (group, indicator) from a year on, first ``limit`` groups."""
    return (
        df.where(F.col(spec.year) >= since)
        .groupBy(spec.group, spec.indicator)
        .agg(
            round_to(mean(F.col(spec.value), spec.scale), 2).alias("avg_val"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy(spec.group, spec.indicator)
        .limit(limit)
    )


def dynamics(df: DataFrame, indicator: str, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Mean by (group, year) of one indicator, in year order."""
    return (
        df.where(F.col(spec.indicator) == indicator)
        .groupBy(spec.group, spec.year)
        .agg(mean(F.col(spec.value), spec.scale).alias("avg"))
        .orderBy(spec.year, spec.group)
    )


def top_means(
    df: DataFrame, indicator: str, n: int = 5, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Entities with the highest mean of one indicator; ties go by name.

    Records that lack one of the columns have no means: the result is empty.
    """
    if not {spec.entity, spec.indicator, spec.value} <= set(df.columns):
        return df.sparkSession.createDataFrame(
            [], f"`{spec.entity}` string, avg_value double, n bigint"
        )
    return (
        df.where((F.col(spec.indicator) == indicator) & F.col(spec.value).isNotNull())
        .groupBy(spec.entity)
        .agg(
            mean(F.col(spec.value), spec.scale).alias("avg_value"),
            F.count(F.lit(1)).alias("n"),
        )
        .orderBy(F.desc("avg_value"), spec.entity)
        .limit(n)
    )


def latest_year(
    df: DataFrame, indicator: str, stats: dict[str, Column], spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """One row: the indicator's latest year and the given aggregates over that year.

    Aggregates per year in one scan and keeps the latest, instead of a second
    pass that compares with a maximum.  All columns are null if the indicator
    does not occur.
    """
    by_year = (
        df.where(F.col(spec.indicator) == indicator)
        .groupBy(F.col(spec.year).alias("_year"))
        .agg(F.struct(*[c.alias(name) for name, c in stats.items()]).alias("_stats"))
    )
    return by_year.agg(
        F.max("_year").alias("year"), F.max_by("_stats", "_year").alias("_stats")
    ).select("year", *[F.col(f"_stats.{name}").alias(name) for name in stats])


def kpi_total(
    df: DataFrame, indicator: str, unit: float = 1e6, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Sum at the latest year, plain and in units (millions)."""
    stats = {"total": total(F.col(spec.value), spec.scale)}
    return latest_year(df, indicator, stats, spec).withColumn(
        "total_in_units", F.col("total") / F.lit(unit)
    )


def kpi_mean(df: DataFrame, indicator: str, spec: PanelSpec = PanelSpec()) -> DataFrame:
    return latest_year(df, indicator, {"avg": mean(F.col(spec.value), spec.scale)}, spec)


def kpi_negative(df: DataFrame, indicator: str, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rows below zero at the latest year."""
    return latest_year(df, indicator, {"n": F.count_if(F.col(spec.value) < 0)}, spec)


def histogram(
    df: DataFrame, indicator: str, bins: int = 40, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Equal-width histogram of one indicator: (bin, low, high, n), empty bins included.

    Bins are half open except for the last; a single distinct value gets a range
    of one around it.  Rows are assigned by position and then corrected against
    the printed edges, so counts and edges always agree.
    """
    rows = df.where(F.col(spec.indicator) == indicator).select(F.col(spec.value).alias("v"))
    found = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    span = found.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ).alias("span")
    )
    # a scalar subquery: the bounds become constants of the counting pass
    bounds = span.scalar()
    lo, hi = bounds["lo"], bounds["hi"]

    def edge(i: Column) -> Column:
        inner = F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.lit(float(bins)))
        return F.when(i == bins, F.col("hi")).otherwise(inner)

    position = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    i = F.col("i")
    settled = (
        F.when(F.col("v") < edge(i), i - 1)
        .when((F.col("v") >= edge(i + 1)) & (i != bins - 1), i + 1)
        .otherwise(i)
    )
    counts = (
        rows.select("v", lo.alias("lo"), hi.alias("hi"))
        .withColumn("i", F.least(position, F.lit(bins - 1)))
        .groupBy(settled.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = (
        span.select("span.*")
        .where(F.col("lo").isNotNull())
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
        .select(
            "bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high")
        )
    )
    # both sides have one row per bin
    return (
        grid.join(F.broadcast(counts), "bin", "left")
        .select(
            (F.col("bin") + 1).alias("bin"),
            "low",
            "high",
            F.coalesce(F.col("n"), F.lit(0)).alias("n"),
        )
        .orderBy("bin")
    )


def extent(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Row count and year range."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(spec.year).alias("first_year"),
        F.max(spec.year).alias("last_year"),
    )
