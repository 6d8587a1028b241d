"""Keyed JSON messages: options of the broker source and the shared parser.

The broker connector is not part of PySpark; ``broker_stream`` needs the
``spark-sql-kafka`` package on the class path.  Everything after the bytes is
the same for a file stream, which is how it is tested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.schema import CORRUPT_COLUMN, MESSAGE_TOPIC, RECORD_SCHEMA


# Column with the time a message came in.
ARRIVED = "arrived"


def broker_options(
    brokers: str,
    topic: str = MESSAGE_TOPIC,
    group: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Source options: read from the earliest offset, optionally rate limited."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if group:
        options["groupIdPrefix"] = group
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def broker_stream(spark: SparkSession, brokers: str, **options) -> DataFrame:
    """Unbounded texts of a topic with the broker's time stamp as arrival time."""
    reader = spark.readStream.format("kafka").options(**broker_options(brokers, **options))
    return reader.load().select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias(ARRIVED)
    )


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The file twin of :func:`broker_stream`: one message per line, arriving when
    its file was written."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    written = F.col("_metadata.file_modification_time")
    return reader.text(path).select("value", written.alias(ARRIVED))


def _parsed(text: Column, schema: T.StructType) -> Column:
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}
    return F.from_json(text, with_bad, options)


def parse_messages(
    messages: DataFrame, schema: T.StructType = RECORD_SCHEMA, keep_bad: bool = False
) -> DataFrame:
    """Records of JSON messages; unreadable ones are skipped, or marked in ``bad``.

    Other columns of the messages, such as the arrival time, are carried along.
    """
    carried = [c for c in messages.columns if c != "value"]
    parsed = messages.select("value", *carried, _parsed(F.col("value"), schema).alias("_r"))
    bad = F.col("_r").isNull() | F.col(f"_r.{CORRUPT_COLUMN}").isNotNull()
    fields = [F.col(f"_r.{f.name}").alias(f.name) for f in schema.fields]
    fields += [F.col(c) for c in carried]
    if keep_bad:
        return parsed.select(*fields, bad.alias("bad"))
    return parsed.where(~bad).select(*fields)
