"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows get the numbers 0..n-1 in the order of their ids.  A keyed Feistel network
permutes the smallest grid a x b that holds n numbers, and numbers that leave 0..n-1 are
walked along their cycle until they are back.  Shard and slot are quotient and
remainder of the permuted number, so each can be computed from the row number alone, and
shard sizes differ by one at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm.common import map_batches, stage

SHARDS = 16
ROUNDS = 6
# A prime below 2^31: products of two residues stay below 2^62.
PRIME = (1 << 31) - 1


def grid(n: int) -> tuple[int, int]:
    """The two moduli of the network; their product is at least ``n``, by less than one row."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int]]:
    keys = np.random.default_rng(seed).integers(1, PRIME, (rounds, 2))
    return [(int(a), int(b)) for a, b in keys]


def _scramble(x: np.ndarray, key: tuple[int, int]) -> np.ndarray:
    y = (x + key[0]) % PRIME
    y = y * y % PRIME
    return (y * key[1] + x) % PRIME


def permute(number: np.ndarray, n: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Image of each row number (0..n-1) under the keyed permutation of 0..n-1."""
    a, b = grid(n)
    keys = round_keys(seed, rounds)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x // b, x % b
        for i, key in enumerate(keys):
            if i % 2:
                right = (right + _scramble(left, key)) % b
            else:
                left = (left + _scramble(right, key)) % a
        return left * b + right

    out = network(number.astype(np.int64))
    outside = np.flatnonzero(out >= n)
    while outside.size:
        out[outside] = network(out[outside])
        outside = outside[out[outside] >= n]
    return out


def numbered(df: DataFrame, order: list[str], out: str = "row_number") -> tuple[DataFrame, int]:
    """Add the global row number in the given order, and return the number of rows.

    Rows are range partitioned and sorted; a partition's numbers start after the rows of
    all partitions before it.  The ranges are frozen in the shared folder first.  The
    table of offsets has one row per partition, which bounds its broadcast.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    frozen = stage(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frozen.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    rows = (
        frozen.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + inside)
        .drop("_part", "_place", "_offset")
    )
    return rows, frozen.count()


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, row_number, place, shard, slot for each row.

    Row counts of shards differ by one at most and slots are gapless from 0 in each.  Null
    text has size 1 and the checksum of the empty string; null ids come first.  Rows that
    repeat an id are ordered by checksum and size, so only equal result rows can tie.
    """
    text = F.col(text_col)
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows, n = numbered(narrow, ["doc_id", "text_crc32", "size"])
    schema = "doc_id {}, size bigint, text_crc32 bigint, row_number bigint, place bigint"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            image = permute(batch.column("row_number").to_numpy(), n, seed)
            yield batch.append_column("place", pa.array(image, pa.int64()))

    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", "size", "text_crc32", "row_number")
    return map_batches(rows, place, schema.format(kind)).select(
        "*",
        F.expr(f"cast(place % {shards} as int)").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = 0) -> None:
    """Write documents into one folder per shard, each file sorted by slot.

    A shard is spread over as many files as its ranges of slots take partitions.
    """
    placed = assign_shards(docs, shards, seed).select("doc_id", "shard", "slot")
    (
        docs.join(placed.withColumnRenamed("doc_id", "_id"), F.col("doc_id").eqNullSafe(F.col("_id")))
        .drop("_id")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
