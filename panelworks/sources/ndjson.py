"""NDJSON scans.  Schemas are explicit: no inference pass, no silent drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.operators.clean import without_service_rows
from panelworks.operators.validate_json import kind_is, parsed_fields, typed_value
from panelworks.schema import CORRUPT_COLUMN, RECORD_SCHEMA, SERVICE_PREFIX, PanelSpec

_MODES = {"fail": "FAILFAST", "drop": "DROPMALFORMED", "keep": "PERMISSIVE"}


def with_input_order(df: DataFrame, out: str = "seq") -> DataFrame:
    """Add the position of a row in its files: (path, split start, row in task).

    Only for frames read straight from files.  A task reads a split from front to
    back, so the triple sorts like the lines of each file do.
    """
    return df.select(
        "*",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(out),
    )


def load_raw(
    spark: SparkSession,
    path: str | list[str],
    on_bad: str = "fail",
    numbered: bool = False,
    schema: T.StructType = RECORD_SCHEMA,
) -> DataFrame:
    """Records of NDJSON files without service rows; blank lines are ignored.

    ``on_bad`` says what happens to lines that do not fit: ``fail`` stops the
    job, ``drop`` skips them, ``keep`` leaves them in with the text in
    ``_corrupt_record`` so that they can be reported.
    """
    reader = spark.read.option("mode", _MODES[on_bad])
    if on_bad == "keep":
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    df = reader.schema(schema).json(path)
    if numbered:
        df = with_input_order(df)
    if on_bad == "keep":
        bad = F.col(CORRUPT_COLUMN).isNotNull()
        return df.where(bad | ~F.col("indicator").startswith(SERVICE_PREFIX))
    return without_service_rows(df)


def lenient_records(lines: DataFrame, text: str = "value") -> DataFrame:
    """Records of JSON lines the forgiving way.

    A line that is not JSON, or has a field of another type, is skipped; absent
    and null fields become ``""`` and 0.  Types are checked on the parsed value,
    because a schema would read the number 42 as text without complaint.
    """
    kinds = {
        "region": ("STRING",),
        "federal_district": ("STRING",),
        "year": ("BIGINT",),
        "indicator": ("STRING",),
        "value": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"),
        "collected_at": ("STRING",),
    }
    fields = parsed_fields(lines, list(kinds), text).withColumn(
        "_at", F.try_to_timestamp(typed_value("collected_at", "string"))
    )
    # the line "null" is an empty record, any other text but an object is not one
    good = F.col("_kind").isin("OBJECT", "VOID")
    for name, allowed in kinds.items():
        good = good & F.coalesce(kind_is(name, *allowed, "VOID"), F.lit(True))
    good = good & (F.col("_at").isNotNull() | ~F.coalesce(kind_is("collected_at", "STRING"),
                                                          F.lit(False)))

    def filled(name: str, as_type: str, default) -> Column:
        return F.coalesce(typed_value(name, as_type), F.lit(default)).alias(name)

    records = fields.where(good).select(
        filled("region", "string", ""),
        filled("federal_district", "string", ""),
        filled("year", "bigint", 0),
        filled("indicator", "string", ""),
        filled("value", "double", 0.0),
        F.col("_at").alias("collected_at"),
    )
    return without_service_rows(records)


def scan_lenient(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return lenient_records(spark.read.text(path))


def read_dimension(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Dimension table from files that hold one JSON array each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def first_records(
    spark: SparkSession, path: str, n: int, spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """First ``n`` records of NDJSON files in file order."""
    rows = with_input_order(spark.read.schema(RECORD_SCHEMA).json(path), "_seq")
    return rows.orderBy("_seq").limit(n).drop("_seq")
