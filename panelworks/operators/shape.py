"""Shards, coverage of the dense grid, baseline residuals, clamping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelworks.functions import clamp, lookup, round_to
from panelworks.operators.ranking import HEAVY_ROWS, number_rows
from panelworks.schema import Baseline, PanelSpec


def assign_shards(
    dimension: DataFrame,
    members: Sequence[str],
    order: Sequence[str],
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Add ``position`` (from 0, in ``order``) and ``member``: item i goes to the
    member at i modulo the number of members, members taken in name order."""
    names = sorted(members)
    table = F.array(*[F.lit(m) for m in names])
    numbered = number_rows(dimension, [], order, "_at", heavy_rows)
    position = F.col("_at") - 1
    return numbered.select(
        *dimension.columns,
        position.alias("position"),
        F.get(table, (position % len(names)).cast("int")).alias("member"),
    )


def shard_of(
    dimension: DataFrame, members: Sequence[str], member: str, order: Sequence[str]
) -> DataFrame:
    """Items of one member; a member that is not registered takes everything."""
    if member not in members:
        return dimension
    return (
        assign_shards(dimension, members, order)
        .where(F.col("member") == member)
        .select(*dimension.columns)
    )


def partition_by_key(
    df: DataFrame, partitions: int = 3, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """All rows of an entity in one of ``partitions`` partitions, in input order.

    What a keyed topic keeps: order inside a key.  An entity too hot for one task has to be
    sent by a finer key.
    """
    order = [c for c in spec.order if c in df.columns]
    return df.repartition(partitions, spec.entity).sortWithinPartitions(*order)


# Cells per bitmap word; below 63 so that words stay positive.
_WORD = 62


def _div(x: Column, by: int) -> Column:
    return F.floor(x / by).cast("int")


def _cell_words(
    df: DataFrame,
    years: tuple[int, int],
    indicators: Sequence[str],
    spec: PanelSpec,
    entities: DataFrame | None = None,
) -> DataFrame:
    """Per entity a bitmap of its grid cells (numbered year-major) in ``_words``.

    Bitmaps have the fixed size of one entity's grid and are or-ed map-side, so
    neither the dense grid nor the raw rows are shuffled.
    """
    codes = {name: i for i, name in enumerate(indicators)}
    inside = F.col(spec.year).between(*years) & F.col(spec.indicator).isin(*indicators)
    cell = (F.col(spec.year) - years[0]) * len(indicators) + lookup(F.col(spec.indicator), codes)
    placed = df.select(spec.entity, F.when(inside, cell.cast("int")).alias("_cell"))
    if entities is not None:
        # rows without a cell: they add entities, in the same aggregation
        placed = placed.union(entities.select(spec.entity, F.lit(None).cast("int")))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_cell") % _WORD)
    words = [
        F.coalesce(
            F.bit_or(F.when(_div(F.col("_cell"), _WORD) == i, bit)), F.lit(0).cast("bigint")
        ).alias(f"_word{i}")
        for i in range(-(-grid_size(years, indicators) // _WORD))
    ]
    names = [f"_word{i}" for i in range(len(words))]
    return placed.groupBy(spec.entity).agg(*words).select(
        spec.entity, F.array(*names).alias("_words")
    )


def grid_size(years: tuple[int, int], indicators: Sequence[str]) -> int:
    return (years[1] - years[0] + 1) * len(indicators)


def coverage(
    df: DataFrame,
    years: tuple[int, int],
    indicators: Sequence[str],
    spec: PanelSpec = PanelSpec(),
    entities: DataFrame | None = None,
) -> DataFrame:
    """Cells expected, present and missing per entity.

    Entities are those of the table, and those of ``entities`` (a frame with the entity
    column, such as a dimension) although they may have no row at all.
    """
    expected = grid_size(years, indicators)
    present = F.aggregate(
        "_words", F.lit(0), lambda total, word: (total + F.bit_count(word)).cast("int")
    )
    return _cell_words(df, years, indicators, spec, entities).select(
        spec.entity,
        F.lit(expected).alias("expected"),
        present.alias("present"),
        (F.lit(expected) - present).alias("missing"),
    )


def gaps(
    df: DataFrame,
    years: tuple[int, int],
    indicators: Sequence[str],
    spec: PanelSpec = PanelSpec(),
    entities: DataFrame | None = None,
) -> DataFrame:
    """(entity, year, indicator) for every grid cell without a row.

    Entities as in :func:`coverage`; one without any row lacks all its cells.
    """
    every = F.sequence(F.lit(0), F.lit(grid_size(years, indicators) - 1))
    names = F.array(*[F.lit(i) for i in indicators])
    width = len(indicators)
    cell = F.col("_cell")
    word = F.get("_words", _div(cell, _WORD))
    taken = F.call_function("shiftright", word, cell % _WORD) % 2 == 1
    return (
        _cell_words(df, years, indicators, spec, entities)
        .select(spec.entity, "_words", F.explode(every).alias("_cell"))
        .where(~taken)
        .select(
            spec.entity,
            (_div(cell, width) + years[0]).alias(spec.year),
            F.get(names, cell % width).alias(spec.indicator),
        )
    )


def _within(year: Column, first: int | None, last: int | None) -> Column:
    condition = F.lit(True)
    if first is not None:
        condition = condition & (year >= first)
    if last is not None:
        condition = condition & (year <= last)
    return condition


def expectation(base: Baseline, spec: PanelSpec = PanelSpec()) -> tuple[Column, Column]:
    """(mu, sigma) of a cell under the baseline; null for unknown indicators."""
    code, year, entity = F.col(spec.indicator), F.col(spec.year), F.col(spec.entity)
    mu = lookup(code, {k: m for k, (m, _) in base.params.items()})
    sigma = lookup(code, {k: s for k, (_, s) in base.params.items()})
    for name, means in base.entity_means.items():
        mu = F.when(code == name, F.coalesce(lookup(entity, means), mu)).otherwise(mu)
    for g in base.growth:
        factor = F.lit(1.0) + (year - g.since) * F.lit(g.rate)
        mu = F.when(code == g.indicator, mu * factor).otherwise(mu)
    for s in base.slopes:
        term = (year - s.since) * F.lit(s.per_year)
        applies = (code == s.indicator) & _within(year, s.first, None)
        mu = F.when(applies, mu + term).otherwise(mu)
    for s in base.steps:
        applies = (code == s.indicator) & _within(year, s.first, s.last)
        mu = F.when(applies, mu + F.lit(s.shift)).otherwise(mu)
    return mu, sigma


def residuals(df: DataFrame, base: Baseline, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Add mu, sigma and z = (value - mu) / sigma."""
    mu, sigma = expectation(base, spec)
    return df.select("*", mu.alias("mu"), sigma.alias("sigma")).withColumn(
        "z", F.try_divide(F.col(spec.value) - F.col("mu"), F.col("sigma"))
    )


def clamp_round(
    df: DataFrame,
    bounds: Mapping[str, tuple[float | None, float | None]],
    digits: int = 1,
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Value bounded per indicator (unlisted ones stay) and rounded."""
    code = F.col(spec.indicator)
    low = lookup(code, {k: lo for k, (lo, _) in bounds.items() if lo is not None})
    high = lookup(code, {k: hi for k, (_, hi) in bounds.items() if hi is not None})
    bounded = clamp(F.col(spec.value), low.cast("double"), high.cast("double"))
    return df.withColumn(spec.value, round_to(bounded, digits))
