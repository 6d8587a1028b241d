"""File sinks.  A dataset is a folder that many tasks write side by side."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.sinks.commits import (
    CommitLog,
    Record,
    batch_folder,
    commit_batch,
    commit_path,
    committed,
)
from panelworks.session import publish, remove

# Times with all their digits; the default stops at milliseconds.
TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def append_ndjson(df: DataFrame, path: str) -> None:
    """Append records as NDJSON; parent folders are made, nothing is replaced."""
    df.write.mode("append").options(**TIMES).json(path)


def write_counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write and return how many rows went through, without running the plan for a test."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return seen.get["n"]


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> bool:
    """Write zstd Parquet; an empty frame leaves no folder, and a folder that was there as it
    is.  True if anything was written.  The plan runs once."""
    beside = f"{path.rstrip('/')}_{uuid.uuid4().hex}"

    def write(rows: DataFrame) -> None:
        rows.write.option("compression", "zstd").parquet(beside)

    return _published(df, path, mode, beside, write)


def _published(
    df: DataFrame, path: str, mode: str, beside: str, write: Callable[[DataFrame], None]
) -> bool:
    """Write to a folder beside ``path`` and move its files in if there are rows."""
    spark = df.sparkSession
    try:
        n = write_counted(df, write)
        if n:
            publish(spark, beside, path, replace=mode == "overwrite")
    finally:
        remove(spark, beside)
    return n > 0


def write_by_indicator(
    df: DataFrame, path: str, indicator: str = "indicator", rebalance: bool = True
) -> None:
    """Parquet laid out by indicator, so that reports prune to one folder.

    The rebalance hint gathers an indicator's rows into files of the advisory
    size and splits a hot indicator over many tasks; without it every task
    writes one file per indicator it meets.
    """
    rows = df.hint("rebalance", F.col(indicator)) if rebalance else df
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(indicator).parquet(path)


def write_rejected(rejected: DataFrame, path: str) -> bool:
    """Rejected records with their errors as NDJSON, only if there are any; written once."""
    beside = f"{path.rstrip('/')}_{uuid.uuid4().hex}"

    def write(rows: DataFrame) -> None:
        rows.write.options(**TIMES).json(beside)

    return _published(rejected.select("record", "errors"), path, "overwrite", beside, write)


def aggregated_path(raw_path: str) -> str:
    """Folder of window aggregates that belongs to a raw output path."""
    parent, slash, _ = raw_path.rstrip("/").rpartition("/")
    return f"{parent}{slash}aggregated.ndjson"


def append_aggregates(aggregates: DataFrame, raw_path: str, batch_id: int | None = None) -> None:
    """Append window aggregates next to the raw output.

    With the number of their batch they get a folder and a commit of their own, so that a replay
    adds nothing; :func:`committed_aggregates` reads them.
    """
    path = aggregated_path(raw_path)
    if batch_id is None:
        aggregates.write.mode("append").options(**TIMES).json(path)
        return
    log = CommitLog(aggregates.sparkSession, commit_path(path))

    def write(_: Record | None) -> tuple[dict[str, int], dict]:
        folder = batch_folder(path, batch_id)
        n = write_counted(
            aggregates, lambda rows: rows.write.mode("overwrite").options(**TIMES).json(folder)
        )
        return {"aggregates": n}, {}

    commit_batch(log, batch_id, write)


def committed_aggregates(spark: SparkSession, raw_path: str, schema: T.StructType) -> DataFrame:
    """What :func:`append_aggregates` has written batch by batch."""
    path = aggregated_path(raw_path)
    return committed(spark, path, schema, "aggregates", form="json", options=TIMES)
