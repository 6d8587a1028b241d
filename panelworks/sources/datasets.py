"""Parquet scan and the newest-dataset rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.operators.clean import without_service_rows
from panelworks.schema import RECORD_SCHEMA, SKIPPED_NAMES
from panelworks.sources.ndjson import load_raw


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """Panel from Parquet (``*.parquet``) or NDJSON, without service rows."""
    if path.rstrip("/").endswith(".parquet"):
        return without_service_rows(spark.read.parquet(path))
    return load_raw(spark, path)


def latest_dataset(
    spark: SparkSession, root: str, skipped: tuple[str, ...] = SKIPPED_NAMES
) -> DataFrame:
    """One row (dataset, modified): the newest ``*.parquet`` or ``*.ndjson`` below root.

    A dataset is a single file or a folder of part files with that ending.
    Service files are skipped by the dataset's own name, whatever its folders are
    called.  Both columns are null if nothing is found.  Only file names and times are read, never contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "modificationTime")
    )
    home = root.rstrip("/").split("://")[-1].removeprefix("file:")
    below = F.element_at(F.split(F.col("path"), f"\\Q{home}\\E/", 2), -1)
    dataset = F.regexp_extract(below, r"^(?:[^/]+/)*?[^/]+\.(?:parquet|ndjson)(?=/|$)", 0)
    listed = files.select(dataset.alias("dataset"), F.col("modificationTime").alias("modified"))
    wanted = F.col("dataset") != ""
    for word in skipped:
        wanted = wanted & ~F.substring_index("dataset", "/", -1).contains(word)
    return listed.where(wanted).agg(
        F.max_by("dataset", F.struct("modified", "dataset")).alias("dataset"),
        F.max("modified").alias("modified"),
    )


def load_latest(spark: SparkSession, root: str) -> DataFrame | None:
    """Panel of the newest dataset, ``None`` if there is none."""
    found = latest_dataset(spark, root).first()["dataset"]
    return None if found is None else read_panel(spark, f"{root.rstrip('/')}/{found}")


def empty_panel(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RECORD_SCHEMA)
