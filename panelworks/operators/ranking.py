"""Running totals, row numbers and exact medians that survive hot groups.

A SQL window sorts every group inside one task.  That is the best plan while
groups are small and fails when one group holds a large part of the table.  The
functions here store their input once in the shared folder and take group sizes from
there, so the source is read once.  Ordinary groups go to a SQL window; the rows of
heavy groups are spread over range partitions whose subtotals are then added up.
There may be any number of heavy groups, and their list stays distributed.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.session import shuffle_partitions, stored

# Rows one task can sort comfortably; a group above this is treated as heavy.
HEAVY_ROWS = 2_000_000

_PART = "_range"
_OFFSET = "_offset"


def heavy_groups(df: DataFrame, by: Sequence[str], rows: int = HEAVY_ROWS) -> DataFrame:
    """(group columns, _size) of the groups with more than ``rows`` rows."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > rows)


def join_groups(left: DataFrame, groups: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    """Null-safe join on the group columns, which show up once.

    Spark broadcasts ``groups`` if it turns out small, and else splits hot partitions.
    """
    renamed = groups.withColumnsRenamed({c: f"_key_{c}" for c in by})
    on = F.lit(True)
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_key_{c}"))
    return left.join(renamed, on, how).drop(*[f"_key_{c}" for c in by])


def split_heavy(
    df: DataFrame, by: Sequence[str], heavy: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(ordinary rows, rows of heavy groups)."""
    return join_groups(df, heavy, by, "left_anti"), join_groups(df, heavy, by, "left_semi")


def _ranges_for(heavy: DataFrame, rows: int) -> int:
    """Ranges for the rows of the heavy groups; 0 if there is none."""
    held = heavy.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    if held == 0:
        return 0
    return max(2, math.ceil(held / rows) + 1, shuffle_partitions(heavy.sparkSession))


def _ranged_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    weight: Column,
    out: str,
    ranges: int,
) -> DataFrame:
    """Running total of ``weight`` with the rows of a group spread over ranges.

    The range assignment is frozen in the shared folder: it must be the same
    in the subtotals and in the rows, also after an executor was lost.
    """
    frozen = stored(
        df.withColumn("_w", weight.cast("bigint"))
        .repartitionByRange(ranges, *by, *order)
        .withColumn(_PART, F.spark_partition_id()),
        "ranges",
    )
    before = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # A range border cuts at most one group, so at most ranges - 1 rows carry a
    # positive offset: the broadcast is bounded by the partition count.
    offsets = (
        frozen.groupBy(*by, _PART)
        .agg(F.sum("_w").alias("_w"))
        .select(*by, _PART, F.sum("_w").over(before).alias(_OFFSET))
        .where(F.col(_OFFSET) > 0)
    )
    local = (
        Window.partitionBy(_PART, *by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    joined = join_groups(frozen, F.broadcast(offsets), [*by, _PART], "left")
    return joined.withColumn(
        out, F.coalesce(F.col(_OFFSET), F.lit(0)) + F.sum("_w").over(local)
    ).drop("_w", _PART, _OFFSET)


def running_total(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    out: str,
    weight: Column | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over a group's rows up to this one.

    Without ``weight`` this is the row number, starting at 1.  ``order`` should
    identify a row within its group, since equal rows stay on one task.
    """
    plain = weight is None
    weight = F.lit(1) if plain else weight
    window = Window.partitionBy(*by).orderBy(*order)
    rows = stored(df, "rows")

    def ordinary(part: DataFrame) -> DataFrame:
        if plain:
            return part.withColumn(out, F.row_number().over(window).cast("bigint"))
        framed = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumn(out, F.sum(weight.cast("bigint")).over(framed))

    heavy = heavy_groups(rows, by, heavy_rows)
    ranges = _ranges_for(heavy, heavy_rows)
    if not ranges:
        return ordinary(rows)
    if not by:
        return _ranged_total(rows, by, order, weight, out, ranges)
    light, hot = split_heavy(rows, by, heavy)
    return ordinary(light).unionByName(_ranged_total(hot, by, order, weight, out, ranges))


def number_rows(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    out: str = "row_number",
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Exact row number (from 1) per group, for groups of any size."""
    return running_total(df, by, order, out, heavy_rows=heavy_rows)


def value_runs(df: DataFrame, by: Sequence[str], value: str, count: str = "n") -> DataFrame:
    """How often each value occurs per group; combines map-side."""
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias(count))


# Bits that one round of radix selection settles; a histogram has 2 ** DIGIT bins at most.
DIGIT = 16
_LARGEST = (1 << 63) - 1


def order_image(value: Column) -> Column:
    """A 64-bit integer per double that sorts like the double, NaN last and both zeros equal."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0))
    bits = bits.cast("bigint")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(_LARGEST))).otherwise(bits)


def image_value(image: Column) -> Column:
    """The double of an :func:`order_image`."""
    bits = F.when(image < 0, image.bitwiseXOR(F.lit(_LARGEST))).otherwise(image)
    text = F.java_method(F.lit("java.lang.Double"), F.lit("longBitsToDouble"), bits)
    return text.cast("double")


def heavy_median(
    runs: DataFrame, by: Sequence[str], value: str, count: str, out: str
) -> DataFrame:
    """Exact median per heavy group by radix selection over its value runs.

    Values become integers that sort alike.  Each of four rounds counts the next 16 bits of
    those that still may be the median, which combines map-side into at most 65,536 bins per group
    whatever the group's size, and keeps the bin that holds the rank.  Rows are neither
    sorted nor dealt by range; only the bins of a group are put in order.
    """
    image = order_image(F.col(value).cast("double"))
    present = stored(
        runs.where(F.col(value).isNotNull()).select(*by, image.alias("_image"), count), "images"
    )
    size = F.sum(count)
    # ranks of the two middle values among those with the prefix; null where one is elsewhere
    targets = present.groupBy(*by).agg(
        F.floor((size + 1) / 2).alias("_low"), (F.floor(size / 2) + 1).alias("_high")
    ).withColumn("_prefix", F.lit(0).cast("bigint"))
    upto = Window.partitionBy(*by, "_prefix").orderBy("_bin")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for shift in range(64 - DIGIT, -1, -DIGIT):
        above = shift + DIGIT
        prefix = F.shiftright("_image", above) if above < 64 else F.lit(0).cast("bigint")
        bins = (
            join_groups(present.withColumn("_prefix", prefix), targets, [*by, "_prefix"], "inner")
            .groupBy(*by, "_prefix", "_low", "_high", F.shiftright("_image", shift).alias("_bin"))
            .agg(F.sum(count).alias("_held"))
            .withColumn("_upto", F.sum("_held").over(upto))
        )
        before = F.col("_upto") - F.col("_held")

        def inside(rank: str, before: Column = before) -> Column:
            here = (F.col(rank) > before) & (F.col(rank) <= F.col("_upto"))
            return F.when(here, F.col(rank) - before).alias(rank)

        targets = bins.select(
            *by, F.col("_bin").alias("_prefix"), inside("_low"), inside("_high")
        ).where("_low is not null or _high is not null")

    def at(rank: str) -> Column:
        return F.max(F.when(F.col(rank).isNotNull(), F.col("_prefix"))).alias(rank)

    middle = (image_value(F.col("_low")) + image_value(F.col("_high"))) / 2
    return targets.groupBy(*by).agg(at("_low"), at("_high")).select(*by, middle.alias(out))
