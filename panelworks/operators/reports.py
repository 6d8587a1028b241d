"""Filters, slices, top-k tables, labels and score columns."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.functions import (
    label_of,
    mean,
    min_max_score,
    round_to,
    truncated_to_millis,
)
from panelworks.schema import ABSENT_LABEL, FilterSpec, PanelSpec


def matches(want: FilterSpec, spec: PanelSpec = PanelSpec()) -> Column:
    """Conjunction of the filter's set fields; true if none is set."""
    condition = F.lit(True)
    if want.indicator:
        condition = condition & (F.col(spec.indicator) == want.indicator)
    if want.year_from:
        condition = condition & (F.col(spec.year) >= want.year_from)
    if want.year_to:
        condition = condition & (F.col(spec.year) <= want.year_to)
    if want.region:
        condition = condition & (F.col(spec.entity) == want.region)
    return condition


def fetch(df: DataFrame, want: FilterSpec, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Matching rows in the exchange shape: 32-bit year, time in milliseconds."""
    shaped = [
        F.col(spec.entity),
        F.col(spec.group),
        F.col(spec.year).cast("int").alias(spec.year),
        F.col(spec.indicator),
        F.col(spec.value),
        # back to the column's own type: truncation yields a zoned time stamp
        truncated_to_millis(F.col(spec.at)).cast(df.schema[spec.at].dataType).alias(spec.at),
    ]
    return df.where(matches(want, spec)).select(*shaped)


def fetch_metrics(fetched: DataFrame, batch_rows: int = 1000) -> DataFrame:
    """Rows and transfer batches of a fetch."""
    return fetched.agg(
        F.count(F.lit(1)).alias("rows"),
        F.ceil(F.count(F.lit(1)) / batch_rows).alias("batches"),
    )


def arrow_footprint(fetched: DataFrame, batch_rows: int = 1000) -> DataFrame:
    """Rows, Arrow batches and their bytes as each task would send them.

    Only the sizes leave a task.  ``fetched.toArrow()`` is the client call that
    brings the rows themselves to the driver.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.slice(i, batch_rows) for i in range(0, batch.num_rows, batch_rows)]
            yield pa.RecordBatch.from_pydict(
                {"rows": [p.num_rows for p in parts], "bytes": [p.nbytes for p in parts]},
                schema=pa.schema([("rows", pa.int64()), ("bytes", pa.int64())]),
            )

    sizes = fetched.mapInArrow(measure, "rows bigint, bytes bigint")
    return sizes.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("arrow_bytes"),
    )


def fetch_group_stats(fetched: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    value = F.col(spec.value)
    return (
        fetched.groupBy(spec.group)
        .agg(
            mean(value, spec.scale).alias("avg"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.count(F.lit(1)).alias("count"),
        )
        .orderBy(F.desc("avg"), spec.group)
    )


def panel_filter(
    df: DataFrame,
    years: tuple[int, int],
    groups: Sequence[str] | DataFrame,
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Inclusive year range and group list; rows without a group drop out.

    The list may be a frame with the group column, which then stays distributed.
    """
    if isinstance(groups, DataFrame):
        wanted = groups.select(spec.group)
        return df.where(F.col(spec.year).between(*years)).join(wanted, spec.group, "left_semi")
    return df.where(F.col(spec.year).between(*years) & F.col(spec.group).isin(*groups))


def slice_of(
    df: DataFrame, indicator: str, year: int, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    return df.where((F.col(spec.indicator) == indicator) & (F.col(spec.year) == year))


def by_value(spec: PanelSpec) -> list[Column]:
    """Highest value first; ties by entity, then by input order."""
    return [F.col(spec.value).desc_nulls_last(), F.col(spec.entity).asc()]


def _ties(df: DataFrame, spec: PanelSpec) -> list[Column]:
    return by_value(spec) + [F.col(c).asc() for c in spec.order if c in df.columns]


def year_slice(
    df: DataFrame, indicator: str, year: int, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """The whole slice, highest value first."""
    part = slice_of(df, indicator, year, spec)
    return part.orderBy(*_ties(part, spec))


def top_slice(
    df: DataFrame, indicator: str, year: int, n: int = 10, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Top rows of a slice with the value rounded to one decimal."""
    part = slice_of(df, indicator, year, spec)
    return (
        part.orderBy(*_ties(part, spec))
        .limit(n)
        .select(F.col(spec.entity), round_to(F.col(spec.value), 1).alias("value"))
    )


def top_scored(
    df: DataFrame, indicator: str, year: int, n: int = 20, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Top rows of a slice with their min-max score within the top rows."""
    part = slice_of(df, indicator, year, spec)
    top = part.orderBy(*_ties(part, spec)).limit(n)
    # the window sees n rows at most
    everything = Window.partitionBy(F.lit(0))
    value = F.col(spec.value)
    return top.select(
        spec.entity,
        spec.group,
        spec.value,
        min_max_score(value, F.min(value).over(everything), F.max(value).over(everything)).alias(
            "score"
        ),
    )


def top_stats(
    df: DataFrame, indicator: str, year: int, n: int = 20, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Median, minimum and maximum over the top rows of a slice."""
    part = slice_of(df, indicator, year, spec)
    top = part.orderBy(*_ties(part, spec)).limit(n).select(F.col(spec.value).alias("v"))
    return top.agg(
        F.percentile("v", 0.5).alias("median"), F.min("v").alias("min"), F.max("v").alias("max")
    )


def with_labels(
    df: DataFrame, labels: Mapping[str, str], spec: PanelSpec = PanelSpec()
) -> DataFrame:
    return df.withColumn("label", label_of(F.col(spec.indicator), labels))


def sorted_distinct(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def first_rows(df: DataFrame, n: int, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """First ``n`` rows in input order."""
    order = [F.col(c) for c in spec.order if c in df.columns]
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def total_label(kpi: DataFrame, unit_name: str = "млн") -> DataFrame:
    """Caption of :func:`aggregate.kpi_total`; a dash if the indicator is absent."""
    text = F.format_string(f"%.1f {unit_name} (за %d)", F.col("total_in_units"), F.col("year"))
    return _label(kpi, text)


def mean_label(kpi: DataFrame, unit_name: str = "лет") -> DataFrame:
    return _label(kpi, F.format_string(f"%.1f {unit_name} (за %d)", F.col("avg"), F.col("year")))


def count_label(kpi: DataFrame, unit_name: str = "регионов") -> DataFrame:
    return _label(kpi, F.format_string(f"%d {unit_name}", F.col("n")))


def _label(kpi: DataFrame, text: Column) -> DataFrame:
    return kpi.select(
        F.when(F.col("year").isNull(), F.lit(ABSENT_LABEL)).otherwise(text).alias("label")
    )
