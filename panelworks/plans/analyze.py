"""Batch run: load, clean, validate, split, aggregate, store, report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.operators.aggregate import average_since, dynamics, group_stats, histogram
from panelworks.operators.clean import clean, typed
from panelworks.operators.reports import top_slice
from panelworks.operators.validate import validate
from panelworks.schema import CORRUPT_COLUMN, DEMOGRAPHIC_RULES, PanelSpec, RuleSet
from panelworks.session import scratch
from panelworks.sinks import write_parquet, write_rejected


@dataclass(frozen=True)
class Analysis:
    """Result frames of a batch run.  They read the table at ``staged``, which is the
    caller's to delete once they are no longer needed."""

    valid: DataFrame
    rejected: DataFrame
    by_group: DataFrame
    staged: str


def flagship(df: DataFrame, rules: RuleSet, spec: PanelSpec = PanelSpec()) -> DataFrame:
    """Clean, validate and aggregate in one plan, without storing anything."""
    checked = validate(clean(df, spec, rules.year_range), rules, spec)
    return group_stats(checked.where("valid"), [spec.group, spec.indicator], spec)


def analyze(
    spark: SparkSession,
    raw: DataFrame,
    output: str | None = None,
    rejected_output: str | None = None,
    rules: RuleSet = DEMOGRAPHIC_RULES,
    spec: PanelSpec = PanelSpec(),
) -> Analysis:
    """Run the whole pipeline.

    Lines that ``load_raw(..., on_bad="keep")`` could not read are rejected with
    their text.  The dedup shuffle happens once: its validated result is written to a table
    in the shared folder, split by outcome, and both halves are read from there.
    The table outlives lost executors, which a cache would not.
    """
    staged = scratch(spark, "validated")
    readable = raw
    if CORRUPT_COLUMN in raw.columns:
        readable = raw.where(F.col(CORRUPT_COLUMN).isNull())
    checked = validate(clean(readable, spec, rules.year_range), rules, spec)
    if readable is not raw:
        unreadable = typed(raw, spec).where(F.col(CORRUPT_COLUMN).isNotNull())
        checked = checked.unionByName(
            unreadable.withColumns(
                {"valid": F.lit(False), "errors": F.array(F.lit("record: malformed"))}
            )
        )
    checked.write.partitionBy("valid").parquet(staged)
    stored = spark.read.schema(checked.schema).parquet(staged)
    columns = [c for c in checked.columns if c not in ("valid", "errors")]
    valid = stored.where(F.col("valid")).select(*[c for c in columns if c != CORRUPT_COLUMN])
    rejected = stored.where(~F.col("valid")).select(
        F.struct(*[F.col(c) for c in columns]).alias("record"), "errors"
    )
    if output:
        write_parquet(valid, output)
    if rejected_output:
        write_rejected(rejected, rejected_output)
    by_group = group_stats(valid, [spec.group, spec.indicator], spec)
    return Analysis(valid, rejected, by_group, staged)


def reports(
    panel: DataFrame, indicator: str, year: int, since: int, spec: PanelSpec = PanelSpec()
) -> dict[str, DataFrame]:
    """The report frames of a stored panel."""
    return {
        "average_since": average_since(panel, since, spec=spec),
        "top_slice": top_slice(panel, indicator, year, spec=spec),
        "dynamics": dynamics(panel, indicator, spec),
        "histogram": histogram(panel, indicator, spec=spec),
    }
