"""Packing into length buckets that minimise padding, and token-budget batches inside.

A histogram over all pieces gives the number of pieces of each length; dynamic programming
over it finds the bucket boundaries with the least padding there can be for
that number of buckets.  Inside a bucket, pieces get gapless positions and every
``budget // boundary`` of them form a batch, whose padded tokens fit the budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelworks.llm.common import WORDS, stage

CONTEXT = 2048
BUCKETS = 8
BUDGET = 65_536
# Cells a bucket is spread over when its pieces are numbered: the unit of work of a task,
# and with BUCKETS the bound of the table of offsets.
CELLS = 1024


def token_count(text: Column) -> Column:
    """Words of the text and one token that ends the document."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint") + 1


def pieces(
    docs: DataFrame, tokens: Column | None = None, context: int = CONTEXT, id_col: str = "doc_id"
) -> DataFrame:
    """doc_id, piece, first_token, n_tokens: documents cut at the context length.

    No token is dropped.  Null and empty texts are one piece of one token.
    """
    tokens = token_count(F.col("text")) if tokens is None else tokens
    counted = docs.select(F.col(id_col).alias("doc_id"), tokens.alias("_tokens"))
    return counted.select(
        "doc_id",
        F.explode(F.expr(f"sequence(0L, (_tokens - 1) div {context})")).alias("piece"),
        "_tokens",
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * context).alias("first_token"),
        F.least(F.lit(context).cast("bigint"), F.col("_tokens") - F.col("piece") * context).alias(
            "n_tokens"
        ),
    )


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Bucket boundaries (longest lengths, ascending) with the least total padding.

    ``lengths`` are distinct and ascending.  best[j] is the least padding of the first j
    lengths with the buckets so far; the last bucket then holds lengths i..j and pads each to
    length j.  Of equal solutions the one with the fewest buckets is returned.
    """
    n = len(lengths)
    if n == 0:
        return []
    lengths = lengths.astype(np.int64)
    rows = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
    tokens = np.concatenate([[0], np.cumsum(counts.astype(np.int64) * lengths)])
    best = lengths * rows[1:] - tokens[1:]
    best = np.concatenate([[0], best])
    choices, least = [np.zeros(n + 1, np.int64)], [best[n]]
    for _ in range(1, min(buckets, n)):
        after, choice = best.copy(), np.zeros(n + 1, np.int64)
        for j in range(1, n + 1):
            i = np.arange(j)
            padding = best[:j] + lengths[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            choice[j] = int(np.argmin(padding))
            after[j] = padding[choice[j]]
        best = after
        choices.append(choice)
        least.append(best[n])
    used, j, out = int(np.argmin(least)), n, []
    while j > 0:
        out.append(int(lengths[j - 1]))
        j = int(choices[used][j])
        used -= 1
    return out[::-1]


def _bucket(bounds: list[int]) -> Column:
    """The smallest boundary that holds the piece."""
    if not bounds:
        return F.lit(None).cast("bigint")
    chosen = F.lit(bounds[-1]).cast("bigint")
    for bound in reversed(bounds[:-1]):
        chosen = F.when(F.col("n_tokens") <= bound, F.lit(bound).cast("bigint")).otherwise(chosen)
    return chosen


def pack(
    docs: DataFrame,
    tokens: Column | None = None,
    context: int = CONTEXT,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
    id_col: str = "doc_id",
) -> DataFrame:
    """doc_id, piece, first_token, n_tokens, bucket_length, batch, slot, padding.

    (bucket_length, batch) names a batch; slot is the place in it.  Only the last batch of
    a bucket may be short.  The histogram has at most ``context`` rows, which bounds what
    the driver sees.  Rows that repeat an id are packed like other rows.
    """
    if budget < context:
        raise ValueError("the token budget must hold one piece of the context length")
    cut = stage(pieces(docs, tokens, context, id_col), "pieces")
    histogram = sorted(
        (r["n_tokens"], r["n"])
        for r in cut.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    lengths, counts = np.array(histogram, np.int64).reshape(-1, 2).T
    cell = F.pmod(F.xxhash64("doc_id", "piece", "n_tokens"), F.lit(CELLS))
    placed = cut.withColumn("bucket_length", _bucket(boundaries(lengths, counts, buckets)))
    placed = placed.withColumn("_cell", cell)
    before = (
        Window.partitionBy("bucket_length")
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        placed.groupBy("bucket_length", "_cell")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "bucket_length",
            "_cell",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        )
    )
    inside = Window.partitionBy("bucket_length", "_cell").orderBy("doc_id", "piece", "n_tokens")
    at = F.col("_offset") + F.row_number().over(inside) - 1
    size = F.expr(f"{budget} div bucket_length")
    return (
        placed.join(F.broadcast(offsets), ["bucket_length", "_cell"])
        .withColumn("_at", at)
        .select(
            "doc_id",
            "piece",
            "first_token",
            "n_tokens",
            "bucket_length",
            F.floor(F.col("_at") / size).alias("batch"),
            (F.col("_at") % size).alias("slot"),
            (F.col("bucket_length") - F.col("n_tokens")).alias("padding"),
        )
    )
