"""Batch forms of the stream windows: tumbling, count, hybrid, sliding, trailing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.functions import common_pane, sum_parts, whole_sum
from panelworks.operators.aggregate import bounded_stats, median_stats
from panelworks.operators.ranking import HEAVY_ROWS, number_rows
from panelworks.schema import PanelSpec


def _slot(spec: PanelSpec, duration: str, offset: str | None) -> Column:
    return F.window(F.col(spec.at), duration, duration, offset or "0 seconds")


def tumbling(
    df: DataFrame,
    duration: str = "10 seconds",
    spec: PanelSpec = PanelSpec(),
    heavy_rows: int = HEAVY_ROWS,
    offset: str | None = None,
) -> DataFrame:
    """Statistics by (window, entity, indicator) over fixed event-time windows.

    Windows are aligned to the epoch, or shifted from it by ``offset`` (shorter than
    ``duration``).
    """
    slot = _slot(spec, duration, offset)
    placed = df.select(
        slot.start.alias("window_start"),
        slot.end.alias("window_end"),
        spec.entity,
        spec.indicator,
        spec.value,
    )
    by = ["window_start", "window_end", spec.entity, spec.indicator]
    return median_stats(placed, by, spec, heavy_rows=heavy_rows)


def count_chunks(
    df: DataFrame,
    size: int,
    by: Sequence[str] = (),
    spec: PanelSpec = PanelSpec(),
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add ``chunk``: rows of a shard in input order, ``size`` rows per chunk."""
    order = [c for c in spec.order if c in df.columns]
    numbered = number_rows(df, list(by), order, "_at", heavy_rows)
    return numbered.withColumn("chunk", F.expr(f"(_at - 1) div {int(size)}")).drop("_at")


def _chunk_stats(chunked: DataFrame, by: list[str], spec: PanelSpec) -> DataFrame:
    """Statistics per chunk, entity and indicator with the chunk's time bounds.

    A chunk holds a fixed number of rows, so the bounds window is small, and its
    partitioning also serves the grouping: no second shuffle.
    """
    whole = Window.partitionBy(*by)
    bounded = chunked.withColumns(
        {
            "window_start": F.min(spec.at).over(whole),
            "window_end": F.max(spec.at).over(whole),
        }
    )
    # the shard may be the entity itself
    keys = dict.fromkeys([*by, "window_start", "window_end", spec.entity, spec.indicator])
    return bounded_stats(bounded, list(keys), spec)


def count_windows(
    df: DataFrame,
    size: int = 50,
    shard: Sequence[str] = (),
    spec: PanelSpec = PanelSpec(),
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Windows that close after ``size`` rows of their shard."""
    chunked = count_chunks(df, size, shard, spec, heavy_rows)
    return _chunk_stats(chunked, [*shard, "chunk"], spec)


def hybrid_chunks(
    df: DataFrame,
    duration: str,
    size: int,
    shard: Sequence[str] = (),
    spec: PanelSpec = PanelSpec(),
    heavy_rows: int = HEAVY_ROWS,
    offset: str | None = None,
) -> DataFrame:
    """Add ``tick`` and ``chunk`` of windows that close on a timer or when full.

    The timer is not restarted by a full window and both ways of closing empty
    the buffer, so a window is exactly (timer bucket, chunk within the bucket).
    """
    ticked = df.withColumn("tick", _slot(spec, duration, offset).start)
    return count_chunks(ticked, size, [*shard, "tick"], spec, heavy_rows)


def hybrid_windows(
    df: DataFrame,
    duration: str = "10 seconds",
    size: int = 50,
    shard: Sequence[str] = (),
    spec: PanelSpec = PanelSpec(),
    heavy_rows: int = HEAVY_ROWS,
    offset: str | None = None,
) -> DataFrame:
    """Statistics over windows that close on a timer or after ``size`` rows."""
    chunked = hybrid_chunks(df, duration, size, shard, spec, heavy_rows, offset)
    return _chunk_stats(chunked, [*shard, "tick", "chunk"], spec)


def pane_sums(spec: PanelSpec) -> list[Column]:
    """Partial sums of a pane, which :func:`window_sum` adds up, and its rows ``n``."""
    value = F.col(spec.value)
    parts = (value.cast("double"), F.lit(None).cast("double"))
    if spec.scale is not None:
        parts = sum_parts(value, spec.scale)
    return [
        F.sum(parts[0]).alias("s"),
        F.sum(parts[1]).alias("s_rest"),
        F.count(F.lit(1)).alias("n"),
    ]


def window_sum(spec: PanelSpec) -> Column:
    return whole_sum(F.sum("s"), F.sum("s_rest"))


def sliding_means(
    df: DataFrame,
    indicator: str | None = None,
    duration: str = "5 minutes",
    slide: str = "30 seconds",
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Mean and count by (sliding window, entity).

    Rows are folded into panes first (the longest step that tiles window and
    slide); only panes are then copied into the windows that cover them, so the
    tenfold fan-out applies to partial sums instead of rows.  Records that lack one
    of the columns have no windows: the result is empty.
    """
    needed = {spec.entity, spec.value, spec.at} | ({spec.indicator} if indicator else set())
    if not needed <= set(df.columns):
        return df.sparkSession.createDataFrame(
            [],
            f"window_start timestamp, window_end timestamp, `{spec.entity}` string, "
            "avg_value double, n bigint",
        )
    rows = df if indicator is None else df.where(F.col(spec.indicator) == indicator)
    value = F.col(spec.value)
    pane = F.window(F.col(spec.at), common_pane(duration, slide)).start
    panes = (
        rows.where(value.isNotNull())
        .groupBy(pane.alias("pane"), F.col(spec.entity))
        .agg(*pane_sums(spec))
    )
    covering = F.window(F.col("pane"), duration, slide)
    return (
        panes.groupBy(covering.alias("w"), F.col(spec.entity))
        .agg(window_sum(spec).alias("s"), F.sum("n").alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            spec.entity,
            (F.col("s") / F.col("n").cast("double")).alias("avg_value"),
            "n",
        )
    )


def top_per_window(means: DataFrame, n: int = 5, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """The ``n`` highest means of each window; ties go by entity name.

    The rank limit is applied before the shuffle, so a window with very many
    entities forwards ``n`` rows per task.
    """
    window = Window.partitionBy("window_start", "window_end").orderBy(
        F.col("avg_value").desc_nulls_last(), F.col(spec.entity)
    )
    return means.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def _cutoff(now: Column, duration: str) -> Column:
    return now - F.expr(f"INTERVAL {duration}")


def trailing(df: DataFrame, now: Column, duration: str, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Rows not older than ``duration`` at ``now``; the edge itself stays."""
    return df.where(F.col(spec.at) >= _cutoff(now, duration))


def evicted_count(
    df: DataFrame, now: Column, duration: str, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """How many rows a trailing window drops and keeps at ``now``."""
    old = F.col(spec.at) < _cutoff(now, duration)
    return df.agg(F.count_if(old).alias("evicted"), F.count_if(~old).alias("kept"))
