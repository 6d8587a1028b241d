"""Keep-first over batches equals keep-first over all rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from panelworks.operators import clean, increment
from panelworks.schema import PanelSpec
from tests.conftest import rows_of

SCHEMA = "region string, indicator string, year int, value double, seq bigint"
SPEC = PanelSpec(order=("seq",))


def rows(n=600, seed=2):
    """A third of the rows have one key; some keys have nulls."""
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        key = ("hot", "x", 2000)
        if seq % 3:
            key = (rng.choice(["a", "b", None, "é"]), rng.choice(["x", "y"]), rng.randrange(1990, 2020))
        out.append((*key, float(seq), seq))
    return out


def parts(spark, own, *bounds):
    df = spark.createDataFrame(own, SCHEMA)
    edges = [0, *bounds, len(own)]
    return [
        df.where((F.col("seq") >= a) & (F.col("seq") < b)).repartition(3)
        for a, b in zip(edges, edges[1:], strict=False)
    ]


@pytest.mark.parametrize("words", [1 << 12, 1])
def test_batches_equal_one_pass(spark, tmp_path, words):
    """Also with a filter of one word, which takes every key for stored."""
    own = rows()
    stored = increment.FirstRows(str(tmp_path / "t"), SPEC, words=words, ranges=4)
    batches = parts(spark, own, 200, 250)
    counts = [stored.add(batch, n) for n, batch in enumerate(batches)]
    schema = batches[0].schema
    whole = clean.keep_first(spark.createDataFrame(own, SCHEMA), SPEC)
    assert rows_of(stored.table(spark, schema), "seq") == rows_of(whole, "seq")
    assert sum(counts) == whole.count() and counts[2] > 0
    assert stored.add(batches[1], 1) is None  # a replay
    assert stored.add(batches[0], 3) == 0  # known keys again
    assert stored.table(spark, schema).count() == whole.count()


def test_filter_is_asked_before_the_rows(spark, tmp_path):
    own = rows(300)
    stored = increment.FirstRows(str(tmp_path / "t"), SPEC, words=1 << 14)
    (batch,) = parts(spark, own)
    stored.add(batch, 0)
    known = batch.select(*SPEC.key).distinct()
    new = known.withColumn("region", F.concat(F.lit("new "), F.coalesce("region", F.lit(""))))
    assert stored.probable(spark, known).count() == known.count()
    assert stored.probable(spark, new).count() <= 0.05 * new.count()


def test_no_rows(spark, tmp_path):
    stored = increment.FirstRows(str(tmp_path / "t"), SPEC)
    empty = spark.createDataFrame([], SCHEMA)
    assert stored.add(empty, 0) == 0
    assert stored.table(spark, empty.schema).count() == 0
    (batch,) = parts(spark, rows(30))
    assert stored.add(batch, 1) == stored.table(spark, empty.schema).count() > 0
