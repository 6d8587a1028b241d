"""Cleaning: required fields, first-wins dedup, plausible years, finite values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.functions import is_finite
from panelworks.schema import SERVICE_PREFIX, PanelSpec


def without_service_rows(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Drop rows whose indicator starts with the service prefix (or is null)."""
    if spec.indicator not in df.columns:
        return df
    return df.where(~F.col(spec.indicator).startswith(SERVICE_PREFIX))


def has_required(spec: PanelSpec = PanelSpec()) -> Column:
    """All required fields are present; NaN counts as present here."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.required])


def input_order(df: DataFrame, spec: PanelSpec) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in spec.order if c in df.columns]


def keep_first(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """First row of each natural key in input order.

    The rank limit is applied before the shuffle as well, so each task forwards
    one row per key at most and a hot key costs no more than any other.
    """
    order = input_order(df, spec)
    if spec.order[-1] not in df.columns:
        raise ValueError(f"{spec.order[-1]}, which makes the input order unique, is not in the table")
    window = Window.partitionBy(*spec.key).orderBy(*order)
    return (
        df.withColumn("_copy", F.row_number().over(window))
        .where(F.col("_copy") == 1)
        .drop("_copy")
    )


def plausible(spec: PanelSpec = PanelSpec(), years: tuple[int, int] = (1990, 2030)) -> Column:
    return F.col(spec.year).between(*years) & is_finite(F.col(spec.value))


def typed(df: DataFrame, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Year as int and value as double; what does not fit becomes null."""
    return df.withColumns(
        {
            spec.year: F.col(spec.year).try_cast("int"),
            spec.value: F.col(spec.value).try_cast("double"),
        }
    )


def clean(
    df: DataFrame, spec: PanelSpec = PanelSpec(), years: tuple[int, int] = (1990, 2030)
) -> DataFrame:
    """Required fields, then first copy per key, then plausible rows, then types.

    The order matters: a key whose first copy is not finite is lost as a whole.
    """
    return typed(keep_first(df.where(has_required(spec)), spec).where(plausible(spec, years)), spec)


def clean_report(
    df: DataFrame, spec: PanelSpec = PanelSpec(), years: tuple[int, int] = (1990, 2030)
) -> DataFrame:
    """One row: rows before and after cleaning and how many each step dropped.

    A single scan: rows are folded per natural key (keeping the first value),
    then the keys are summed up.
    """
    # as in input_order: nulls last
    order = F.struct(
        *[part for c in spec.order if c in df.columns for part in (F.isnull(c), F.col(c))]
    )
    complete = has_required(spec)
    per_key = df.groupBy(*spec.key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(complete).alias("complete"),
        F.min_by(
            F.when(complete, F.struct(F.col(spec.value).alias("v"))), F.when(complete, order)
        ).alias("first"),
    )
    year_ok = F.col(spec.year).between(*years)
    value_ok = is_finite(F.col("first.v"))
    some = F.col("complete") > 0
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_before"),
        F.count_if(some & year_ok & value_ok).alias("rows_after"),
        F.coalesce(F.sum(F.col("rows") - F.col("complete")), F.lit(0)).alias("missing_required"),
        F.coalesce(F.sum(F.when(some, F.col("complete") - 1)), F.lit(0)).alias("later_copies"),
        F.count_if(some & ~year_ok).alias("year_out_of_range"),
        F.count_if(some & year_ok & ~value_ok).alias("not_finite"),
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))
