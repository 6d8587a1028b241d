"""Exact deduplication by distributed MSD radix partitioning.

Documents are split by successive pieces of their bytes.  A level groups the open
documents by (group so far, next piece); a document that is alone, or whose text has
ended, is done.  Pieces grow geometrically, so a text of n bytes takes about
log(n) levels, and only documents that still share their whole prefix with another
one go on.  Texts are compared as they are: no digest decides equality.

Each level is one aggregation of (group, piece) with map-side combining and one join
back to the rows, whose skewed partitions Spark may split, so a large group of copies is
never gathered in one task.  Levels are written to the shared folder.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm.common import SPACES, stage
from panelworks.session import tidy

# Bytes looked at before any text moves, bytes of the first level, growth per level.
PEEK_BYTES = 64
FIRST_BYTES = 512
GROWTH = 8

_DONE = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def normalised(text: Column) -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def _head(text: Column, n: int) -> Column:
    """First ``n`` bytes of the normalised text, from a prefix of the text if that is
    sure to hold them."""
    some = normalised(F.substring(text, 1, 4 * n))
    enough = (F.octet_length(some) >= n) | (F.char_length(text) <= 4 * n)
    head = F.when(text.isNull() | enough, some).otherwise(normalised(text))
    return F.substring(head.cast("binary"), 1, n)


def radix_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    peek: int = PEEK_BYTES,
    first: int = FIRST_BYTES,
    growth: int = GROWTH,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after replacing each run of white space by
    one space.  Null text is empty text, and all empty texts are equal.  The row with
    the smallest id of a group stays; a null id sorts first; of rows that repeat id and text
    exactly one stays.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("head", _head(F.col("text"), peek))
    shared = rows.groupBy("head").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    level = stage(
        rows.join(shared, "head", "left")
        .withColumn("norm", normalised(F.col("text")))
        .select(
            "doc_id",
            F.col("doc_id").alias("keep_id"),
            F.lit(1).cast("bigint").alias("group_size"),
            F.lit(True).alias("kept"),
            F.sha2("norm", 256).alias("text_sha256"),
            F.col("n").isNotNull().alias("open"),
            F.monotonically_increasing_id().alias("row"),
            F.lit(0).cast("bigint").alias("prefix"),
            F.when(F.col("n").isNotNull(), F.col("norm").cast("binary")).alias("rest"),
        ),
        "radix",
    )
    levels, size = [level], first
    while not (active := level.where("open")).isEmpty():
        level = stage(_split(active, size), "radix")
        levels.append(level)
        size *= growth
    return reduce(DataFrame.unionByName, [x.where("not open").select(*_DONE) for x in levels])


def _split(active: DataFrame, size: int) -> DataFrame:
    """Split the open groups by the next ``size`` bytes of their texts."""
    active = active.withColumn("piece", F.substring("rest", 1, size))
    groups = active.groupBy("prefix", "piece").agg(
        F.min(F.struct("doc_id", "row")).alias("lead"), F.count(F.lit(1)).alias("n")
    )
    still = (F.col("n") > 1) & (F.octet_length("piece") == size)
    return active.join(groups, ["prefix", "piece"]).select(
        "doc_id",
        F.col("lead.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("lead.row")).alias("kept"),
        "text_sha256",
        still.alias("open"),
        "row",
        F.col("lead.row").alias("prefix"),
        F.when(still, F.expr(f"substring(rest, {size + 1})")).alias("rest"),
    )


@tidy
def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they are.

    Groups are those of :func:`radix_groups`, so no digest decides which texts are equal.  A
    digest then finds the rows again: of rows that repeat an id with texts equal up to white
    space, the one with the smallest text stays.
    """
    kept = stage(
        radix_groups(docs, id_col, text_col)
        .where("kept")
        .select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text")),
        "kept",
    )
    keyed = docs.withColumn("_text_key", F.sha2(normalised(F.col(text_col)), 256))
    same = (F.col("_kept_id").eqNullSafe(F.col(id_col))) & (
        F.col("_kept_text") == F.col("_text_key")
    )
    least = Window.partitionBy(id_col, "_text_key").orderBy(F.col(text_col))
    return (
        keyed.join(kept, same, "left_semi")
        .withColumn("_place", F.row_number().over(least))
        .where("_place = 1")
        .select(*docs.columns)
    )
