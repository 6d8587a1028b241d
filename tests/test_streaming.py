from __future__ import annotations

import os
import random
import threading
import time
from collections import deque
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from panelworks import sinks, sources, streaming
from panelworks.operators import windows
from panelworks.schema import PanelSpec
from tests.conftest import rows_of
from tests.test_windows import SCHEMA, events


@pytest.fixture()
def source(spark, tmp_path):
    """A file stream fed part by part: ``source.feed(rows)``, ``source.stream()``."""

    class Source:
        path = str(tmp_path / "in")
        work = tmp_path

        def __init__(self):
            os.makedirs(self.path)

        def feed(self, rows):
            df = spark.createDataFrame(rows, SCHEMA)
            df.coalesce(1).write.mode("append").parquet(self.path)

        def stream(self, per_batch=1):
            reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_batch)
            return reader.parquet(self.path)

        def folder(self, name):
            return str(tmp_path / name)

    return Source()


def test_flush_writes_each_batch_once(spark, source):
    for part in range(3):
        source.feed(events()[part * 100 : part * 100 + 100])
    out = source.folder("out.parquet")
    for _ in range(2):  # a second run from the same checkpoint finds nothing new
        query = streaming.flush_stream(source.stream(), out, source.folder("cp"), max_rows=40)
        query.awaitTermination()
    assert sorted(os.listdir(out)) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    files = [f for f in os.listdir(f"{out}/batch_id=0") if f.endswith(".zstd.parquet")]
    assert len(files) == 3  # 100 rows, at most 40 per file
    assert sorted(r.seq for r in spark.read.parquet(out).collect()) == list(range(300))


def test_replayed_batch_replaces_its_own_output(spark, tmp_path):
    df = spark.createDataFrame(events(30), SCHEMA)
    for _ in range(2):
        streaming.flush_batch(df, 7, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 30


def test_empty_batch_writes_nothing(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert streaming.flush_batch(empty, 0, str(tmp_path / "out")) is None
    assert not (tmp_path / "out").exists()


def test_failed_flush_keeps_the_rows(spark, tmp_path):
    def broken(rows, target):
        raise OSError("disk full")

    df = spark.createDataFrame(events(30), SCHEMA)
    target = streaming.flush_batch(df, 0, str(tmp_path / "out"), write=broken)
    assert target.startswith(streaming.emergency_path(str(tmp_path / "out")))
    assert sorted(r.seq for r in spark.read.json(target).collect()) == list(range(30))


def test_bad_messages_are_counted(spark, tmp_path):
    path = tmp_path / "texts"
    path.mkdir()
    (path / "a.txt").write_text('{"region":"A","value":1.0}\n{cut\n{"region":"B"}\n')
    parsed = sources.parse_messages(sources.text_stream(spark, str(path)), keep_bad=True)
    query = streaming.to_parquet(
        streaming.observed(parsed), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    query.awaitTermination()
    seen = [p.observedMetrics["ingest"] for p in query.recentProgress
            if "ingest" in p.observedMetrics]
    assert [sum(m[i] for m in seen) for i in range(3)] == [3, 2, 1]


def test_windows_on_arrival_time(spark, tmp_path):
    path = tmp_path / "texts"
    path.mkdir()
    texts = ['{"region":"A","indicator":"x","value":1.0,"collected_at":"1999-01-01T00:00:00Z"}',
             '{"region":"A","indicator":"x","value":3.0,"collected_at":"2030-01-01T00:00:00Z"}']
    for i, when in enumerate((1_704_067_200, 1_704_067_200 + 7200)):
        file = path / f"{i}.txt"
        file.write_text("\n".join(texts) + "\n")
        os.utime(file, (when, when))
    records = sources.parse_messages(sources.text_stream(spark, str(path), max_files=1))
    means = streaming.sliding_stream(
        records, "x", "1 hour", "1 hour", "0 seconds", PanelSpec(at="arrived")
    )
    out = str(tmp_path / "out")
    streaming.to_parquet(means, out, str(tmp_path / "cp")).awaitTermination()
    (row,) = spark.read.parquet(out).collect()
    assert (row.window_start, row.avg_value, row.n) == (datetime(2024, 1, 1), 2.0, 2)


@pytest.mark.parametrize("heavy_rows", [10_000, 3])
def test_closed_tumbling_windows_equal_the_batch_form(spark, source, heavy_rows):
    rows = events(300)
    for part in range(3):
        source.feed(rows[part * 100 : part * 100 + 100])
    out = source.folder("out")
    exact = PanelSpec(scale=1)  # values with one decimal: sums do not depend on the order
    streaming.tumbling_stream(
        source.stream(),
        out,
        source.folder("cp"),
        "5 minutes",
        "30 seconds",
        spec=exact,
        heavy_rows=heavy_rows,
    ).awaitTermination()
    last = max(r[3] for r in rows).replace(microsecond=0) - timedelta(seconds=30)
    batch = windows.tumbling(spark.createDataFrame(rows, SCHEMA), "5 minutes", exact)
    columns = ["window_start", "region", "indicator", "count", "min", "max", "sum", "avg", "p50"]
    closed = batch.where(F.col("window_end") <= F.lit(last))
    assert rows_of(spark.read.parquet(out), *columns) == rows_of(closed, *columns)
    assert closed.count() > 0


def test_late_rows_are_dropped(spark, source):
    t0 = datetime(2024, 1, 1)
    out, checkpoint = source.folder("out"), source.folder("cp")
    for batch in (
        [("A", "x", 1.0, t0, 0), ("A", "x", 1.0, t0 + timedelta(minutes=10), 1)],
        [("A", "x", 5.0, t0, 2), ("A", "x", 1.0, t0 + timedelta(minutes=20), 3)],
    ):
        source.feed(batch)
        streaming.tumbling_stream(
            source.stream(), out, checkpoint, "1 minute", "0 seconds"
        ).awaitTermination()
    first = spark.read.parquet(out).where(F.col("window_start") == F.lit(t0).cast("timestamp"))
    assert [(r["count"], r.max) for r in first.collect()] == [(1, 1.0)]


def test_stream_top_equals_batch_top(spark, source):
    rows = events(300)
    for part in range(3):
        source.feed(rows[part * 100 : part * 100 + 100])
    means = streaming.sliding_stream(source.stream(), "x", delay="30 seconds")
    streaming.top_stream(
        means, source.folder("out"), source.folder("cp"), 2
    ).awaitTermination()
    got = spark.read.parquet(source.folder("out"))
    last = max(r[3] for r in rows if r[1] == "x").replace(microsecond=0) - timedelta(seconds=30)
    batch = windows.sliding_means(spark.createDataFrame(rows, SCHEMA), "x")
    best = windows.top_per_window(batch, 2).where(F.col("window_end") <= F.lit(last))
    columns = ["window_start", "region", "rank", "n"]
    assert rows_of(got, *columns) == rows_of(best, *columns)


def test_tee_writes_raw_rows_and_their_windows(spark, source):
    source.feed(events(200))
    raw, side = source.folder("raw"), source.folder("side")
    streaming.tee_stream(
        source.stream(), raw, side, source.folder("cp"), "1 minute", 7
    ).awaitTermination()
    streaming.finish_tee(spark, raw, side, "1 minute", 7)
    assert spark.read.parquet(raw).count() == 200
    batch = windows.hybrid_windows(spark.createDataFrame(events(200), SCHEMA), "1 minute", 7)
    columns = ["window_start", "region", "indicator", "count", "p50"]
    assert rows_of(spark.read.parquet(side), *columns) == rows_of(batch, *columns)


def test_tee_windows_do_not_depend_on_the_batches(spark, source):
    """Borders of micro-batches fall into chunks and ticks; runs end and go on."""
    rows = events(300)
    raw, side = source.folder("raw"), source.folder("side")
    for part in range(5):
        source.feed(rows[part * 60 : part * 60 + 60])
        streaming.tee_stream(
            source.stream(), raw, side, source.folder("cp"), "1 hour", 70
        ).awaitTermination()
    streaming.finish_tee(spark, raw, side, "1 hour", 70)
    got = spark.read.parquet(side)
    batch = windows.hybrid_windows(spark.createDataFrame(rows, SCHEMA), "1 hour", 70)
    columns = ["tick", "chunk", "window_start", "window_end", "region", "indicator", "count", "p50"]
    assert rows_of(got, *columns) == rows_of(batch, *columns)
    streaming.finish_tee(spark, raw, side, "1 hour", 70)  # nothing is left to close
    assert rows_of(spark.read.parquet(side), *columns) == rows_of(batch, *columns)


def test_closing_record_emits_open_windows(spark, source):
    rows = events(200)
    for part in range(4):
        source.feed(rows[part * 50 : part * 50 + 50])
    frame = spark.createDataFrame(rows, SCHEMA)
    streaming.closing_record(frame).coalesce(1).write.mode("append").parquet(source.path)
    out = source.folder("out")
    spec = PanelSpec(scale=1)
    streaming.tumbling_stream(
        source.stream(), out, source.folder("cp"), "5 minutes", "1 day", spec=spec
    ).awaitTermination()
    columns = ["window_start", "region", "indicator", "count", "sum", "p50"]
    batch = windows.tumbling(frame, "5 minutes", spec)
    assert rows_of(spark.read.parquet(out), *columns) == rows_of(batch, *columns)


def test_replay_after_an_emergency_has_each_row_once(spark, tmp_path):
    def broken(rows, target):
        raise OSError("disk full")

    df = spark.createDataFrame(events(30), SCHEMA)
    out = str(tmp_path / "out")
    assert streaming.flush_batch(df, 0, out, write=broken) != streaming.flush_batch(df, 0, out)
    assert spark.read.parquet(out).count() == 30
    assert not os.path.exists(f"{streaming.emergency_path(out)}/batch_id=0")
    streaming.flush_batch(df, 0, out, write=broken)
    assert not os.path.exists(f"{out}/batch_id=0")


def test_tee_reads_each_row_about_once(spark, source):
    """What closing ticks read grows with the rows, not with the batches before."""
    rows = sorted(events(1200), key=lambda r: r[3])
    raw, side = source.folder("raw"), source.folder("side.ndjson")
    for part in range(40):
        source.feed(rows[part * 30 : part * 30 + 30])
    tee = streaming.Tee(raw, side, "1 minute", 7)
    read = []
    close = streaming.Tee._close

    def counted(self, session, batch_id, schema, ticks):
        folders = [f"{raw}/batch_id={b}/tick={t}" for b, t in ticks]
        if folders:
            read.append(spark.read.schema(schema).parquet(*folders).count())
        return close(self, session, batch_id, schema, ticks)

    streaming.Tee._close = counted
    try:
        query = streaming.tee_stream(
            source.stream(), raw, side, source.folder("cp"), "1 minute", 7
        )
        query.awaitTermination()
        streaming.finish_tee(spark, raw, side, "1 minute", 7)
    finally:
        streaming.Tee._close = close
    schema = spark.createDataFrame([], SCHEMA).schema
    assert sum(read) == tee.raw(spark, schema).count() == 1200
    columns = ["tick", "chunk", "region", "indicator", "count", "p50"]
    batch = windows.hybrid_windows(spark.createDataFrame(rows, SCHEMA), "1 minute", 7)
    assert rows_of(tee.windows(spark, schema), *columns) == rows_of(batch, *columns)


def test_a_crash_between_outputs_shows_no_row_and_a_replay_each_once(spark, source):
    rows = events(200)
    raw, side = source.folder("raw"), source.folder("side")
    tee = streaming.Tee(raw, side, "1 minute", 7)
    schema = spark.createDataFrame([], SCHEMA).schema
    first, second = (spark.createDataFrame(rows[k : k + 100], SCHEMA) for k in (0, 100))
    tee.run_batch(first, 0)
    before = rows_of(tee.windows(spark, schema), "region", "count")
    close = streaming.Tee._close

    def broken(*args):
        close(*args)  # both outputs are there, the commit is not
        raise OSError("power is out")

    streaming.Tee._close = broken
    try:
        with pytest.raises(OSError):
            tee.run_batch(second, 1)
    finally:
        streaming.Tee._close = close
    assert os.path.exists(f"{raw}/batch_id=1")
    assert tee.raw(spark, schema).count() == 100
    assert rows_of(tee.windows(spark, schema), "region", "count") == before
    for _ in range(2):  # the second run finds the commit
        tee.run_batch(second, 1)
    tee.finish(spark)
    assert sorted(r.seq for r in tee.raw(spark, schema).collect()) == list(range(200))
    columns = ["tick", "chunk", "region", "indicator", "count", "p50"]
    batch = windows.hybrid_windows(spark.createDataFrame(rows, SCHEMA), "1 minute", 7)
    assert rows_of(tee.windows(spark, schema), *columns) == rows_of(batch, *columns)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_ticks_do_not_depend_on_the_session_zone(spark, source, zone):
    t0 = datetime(2024, 3, 10, 1, 30)  # next to a gap of summer time
    rows = [("A", "x", float(k), t0 + timedelta(minutes=20 * k), k) for k in range(12)]
    raw, side = source.folder("raw"), source.folder("side")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        tee = streaming.Tee(raw, side, "1 hour", 2)
        for part in (0, 6):
            tee.run_batch(spark.createDataFrame(rows[part : part + 6], SCHEMA), part // 6)
        schema = spark.createDataFrame([], SCHEMA).schema
        tee.finish(spark)
        got = tee.windows(spark, schema).selectExpr("cast(tick as string) t", "count").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    counts = {}
    for r in got:
        counts[r.t[11:13]] = counts.get(r.t[11:13], 0) + r["count"]
    assert counts == {"01": 2, "02": 3, "03": 3, "04": 3, "05": 1}


def test_another_writer_is_noticed(spark, tmp_path):
    one, other = (sinks.CommitLog(spark, str(tmp_path / "log")) for _ in range(2))
    one.add(0, {"raw": 1}, {})
    last = other.latest()
    other.latest = lambda: None
    with pytest.raises(RuntimeError):
        other.add(0, {"raw": 1}, {})
    assert last == one.latest() and last.seq == 0
    assert [tuple(r) for r in one.records().collect()] == [(0, 0, 0, "raw", 1)]


def test_replayed_aggregates_are_there_once(spark, tmp_path):
    raw = str(tmp_path / "raw.ndjson")
    found = windows.hybrid_windows(spark.createDataFrame(events(50), SCHEMA), "1 minute", 7)
    for batch_id in (0, 0, 1, 1, 0):
        sinks.append_aggregates(found, raw, batch_id)
    got = sinks.committed_aggregates(spark, raw, found.schema)
    columns = ["tick", "chunk", "region", "indicator", "count", "p50"]
    assert rows_of(got, *columns) == sorted(rows_of(found, *columns) * 2)


def test_evictions_equal_the_replay_of_a_queue(spark, source):
    """Rows strictly older than the window go; one at its edge stays until the next tick."""
    t0 = datetime(2024, 1, 1)
    rng = random.Random(4)
    seconds = sorted([0, 10, 10, 20, 60, 70, *(rng.randrange(600) for _ in range(80))])
    rows = [("A", "x", 1.0, t0 + timedelta(seconds=s), k) for k, s in enumerate(seconds)]
    for part in range(4):
        source.feed(rows[part * 22 : part * 22 + 22])
    streaming.closing_record(spark.createDataFrame(rows, SCHEMA)).write.mode("append").parquet(
        source.path
    )
    ticks = streaming.eviction_stream(source.stream(), "1 minute", "10 seconds", "1 hour")
    streaming.to_parquet(ticks, source.folder("out"), source.folder("cp")).awaitTermination()
    got = {
        int((r.tick - t0).total_seconds()): (r.arrived, r.evicted)
        for r in spark.read.parquet(source.folder("out")).collect()
    }
    queue, waiting = deque(), deque(seconds)
    for tick in range(10, 800, 10):
        arrived = evicted = 0
        while waiting and waiting[0] < tick:
            queue.append(waiting.popleft())
            arrived += 1
        while queue and queue[0] < tick - 60:
            queue.popleft()
            evicted += 1
        assert got.get(tick, (0, 0)) == (arrived, evicted), tick
    assert not queue and not waiting


def test_monitor_notes_counters_and_failed_writes(spark, tmp_path):
    path = tmp_path / "texts"
    path.mkdir()
    monitor = streaming.FlowMonitor(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(monitor)
    try:
        for k in range(3):
            (path / f"{k}.txt").write_text('{"region":"A","value":1.0}\n{cut\n{"region":"B"}\n')
        parsed = sources.parse_messages(
            sources.text_stream(spark, str(path), max_files=1), keep_bad=True
        )
        monitor.write_failed()
        query = streaming.to_parquet(
            streaming.observed(parsed), str(tmp_path / "out"), str(tmp_path / "cp")
        )
        query.awaitTermination()
        assert monitor.await_end(query)
    finally:
        spark.streams.removeListener(monitor)
    assert tuple(monitor.totals().first()) == (9, 6, 3, 1)
    rows = monitor.table().where("input_rows > 0").collect()
    assert len(rows) == 3 and {r.records for r in rows} == {2}


def test_queue_depth_of_a_limited_log(spark, tmp_path):
    log = str(tmp_path / "log")
    texts = spark.range(100).selectExpr("cast(id % 7 as string) key", "'{}' value", "id")
    sources.write_log(texts, log, ["id"])
    stream = streaming.monitor._total
    assert [stream(x) for x in ('{"0": 3, "1": 4}', '{"a": "b"}', "7", None, "x")] == [
        7, None, None, None, None,
    ]
    assert sources.read_log(spark, log).count() == 100


@pytest.mark.parametrize("how", ["cancel", "idle"])
def test_open_ticks_are_windowed_at_a_cancel_and_when_idle(spark, source, how):
    rows = events(120)
    source.feed(rows)
    raw, side = source.folder("raw"), source.folder("side")
    tee = streaming.Tee(raw, side, "1 hour", 70)
    monitor = streaming.FlowMonitor(spark, source.folder("metrics"))
    spark.streams.addListener(monitor)
    columns = ["tick", "chunk", "region", "indicator", "count"]
    frame = spark.createDataFrame(rows, SCHEMA)
    want = rows_of(windows.hybrid_windows(frame, "1 hour", 70), *columns)
    try:
        query = streaming.for_each_batch(
            source.stream(), tee.run_batch, source.folder("cp"), "1 second"
        )
        waiter = threading.Thread(
            target=streaming.await_tee, args=(query, tee, spark, monitor, 2.0 if how == "idle" else None, 0.2)
        )
        waiter.start()
        query.processAllAvailable()
        if how == "idle":
            end = time.monotonic() + 60
            while time.monotonic() < end:
                if rows_of(tee.windows(spark, frame.schema), *columns) == want:
                    break
                time.sleep(0.5)
            assert query.isActive
        query.stop()
        waiter.join(60)
    finally:
        spark.streams.removeListener(monitor)
    assert rows_of(tee.windows(spark, frame.schema), *columns) == want
