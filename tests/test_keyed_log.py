"""The keyed log: order per key, offsets, limits, restarts, commits and aborts."""

from __future__ import annotations

import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelworks import sinks, sources
from panelworks.sinks.messages import SinkSpec
from panelworks.sources import keyed_log
from tests.conftest import panel_rows

SCHEMA = "key string, value string, seq bigint"


def messages(n, first=0, seed=1):
    """A third of all messages have one key; some have none."""
    rng = random.Random(seed)
    keys = ["hot", "hot", "a", "b", "c", None]
    return [(rng.choice(keys), f"v{k} é\n\"", first + k) for k in range(n)]


def write(spark, path, rows, **options):
    shuffled = random.Random(3).sample(rows, len(rows))
    df = spark.createDataFrame(shuffled, SCHEMA).repartition(5)
    sources.write_log(df, path, ["seq"], **options)


def in_order(rows):
    """Values per key in the order of offsets; a key has one partition."""
    held, where = defaultdict(list), defaultdict(set)
    for r in sorted(rows, key=lambda r: (r.partition, r.offset)):
        held[r.key].append(r.value)
        where[r.key].add(r.partition)
    assert all(len(x) == 1 for x in where.values())
    return dict(held)


def expected(rows):
    held = defaultdict(list)
    for key, value, _ in sorted(rows, key=lambda r: r[2]):
        held[key].append(value)
    return dict(held)


def test_order_and_offsets(spark, tmp_path):
    path, rows = str(tmp_path / "log"), messages(300) + messages(200, 300, 2)
    write(spark, path, rows[:300])
    write(spark, path, rows[300:])
    got = sources.read_log(spark, path).collect()
    assert in_order(got) == expected(rows)
    offsets = defaultdict(list)
    for r in got:
        offsets[r.partition].append(r.offset)
    assert all(sorted(x) == list(range(len(x))) for x in offsets.values())
    assert not os.listdir(tmp_path / "log" / "_staging")


def test_a_tag_is_written_once(spark, tmp_path):
    path, rows = str(tmp_path / "log"), messages(100)
    for _ in range(3):
        write(spark, path, rows, tag="batch0")
    write(spark, path, messages(10, 100), tag="batch1")
    assert sources.read_log(spark, path).count() == 110


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "log")
    write(spark, path, messages(20))
    broken = spark.range(50).select(
        F.lit("a").alias("key"),
        F.when(F.col("id") == 40, F.raise_error(F.lit("cut"))).otherwise(F.lit("x")).alias("value"),
        F.col("id").alias("seq"),
    )
    with pytest.raises(Exception, match="cut"):
        sources.write_log(broken, path, ["seq"])
    assert sources.read_log(spark, path).count() == 20
    assert sources.read_log(spark, str(tmp_path / "none")).count() == 0


def test_stream_goes_on_from_its_offsets(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / x) for x in ("log", "out", "cp"))
    rows = messages(120) + messages(80, 120, 2)

    def run(limit):
        stream = sources.log_stream(spark, path, limit=limit, reader="test")
        query = (
            stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .option("path", out).start()
        )
        query.processAllAvailable()
        batches = [p.numInputRows for p in query.recentProgress if p.numInputRows]
        query.stop()
        return batches

    write(spark, path, rows[:120])
    first = run(50)
    assert sum(first) == 120 and max(first) <= 50
    write(spark, path, rows[120:])
    second = run(50)  # nothing is read again
    assert sum(second) == 80 and max(second) <= 50
    assert in_order(spark.read.parquet(out).collect()) == expected(rows)


def test_limit_is_shared_by_the_partitions(tmp_path):
    reader = keyed_log._StreamReader(str(tmp_path), 4, 10, "r")
    ends = {"0": 100, "1": 2, "2": 0, "3": 100}
    done = reader.initialOffset()
    for want in ({"0": 4, "1": 2, "2": 0, "3": 4}, {"0": 9, "1": 2, "2": 0, "3": 9}):
        done = reader._limited(done, ends)
        assert done == want
    with pytest.raises(ValueError):
        keyed_log._StreamReader(str(tmp_path), 4, 10, None)


@pytest.mark.parametrize("kind", ["file", "log"])
def test_switchable_sink(spark, tmp_path, kind):
    schema = (
        "region string, federal_district string, year bigint, indicator string, value double, "
        "collected_at timestamp"
    )
    rows = spark.createDataFrame(panel_rows(), schema)
    sink = SinkSpec(kind, path=str(tmp_path / "sink"))
    for _ in range(2):
        sinks.write_to(rows, sink)
    if kind == "file":
        assert spark.read.json(sink.path).count() == 2 * len(panel_rows())
        return
    texts = sources.read_log(spark, sink.path).select("value")
    back = sources.parse_messages(texts)
    assert back.count() == 2 * len(panel_rows())
    assert back.where("region is null or value is null").count() == 0


def test_unknown_sinks_are_refused(spark):
    with pytest.raises(ValueError):
        sinks.write_to(spark.range(1), SinkSpec("nowhere"))
