from __future__ import annotations

import random
from collections import defaultdict
from datetime import datetime, timedelta
from statistics import fmean

import pytest
from pyspark.sql import functions as F

from panelworks.operators import windows
from tests.conftest import rows_of

T0 = datetime(2024, 1, 1)
SCHEMA = "region string, indicator string, value double, collected_at timestamp_ntz, seq long"


def events(n: int = 400, seed: int = 1, step: float = 4.0) -> list[tuple]:
    rng = random.Random(seed)
    at, rows = 0.0, []
    for i in range(n):
        at += rng.expovariate(1 / step)
        when = T0 + timedelta(microseconds=int(at * 1e6))
        region = "hot" if rng.random() < 0.4 else rng.choice("ABC")
        rows.append((region, rng.choice(["x", "y"]), round(rng.uniform(0, 9), 1), when, i))
    return rows


@pytest.fixture(scope="module")
def stream(spark):
    return spark.createDataFrame(events(), SCHEMA).repartition(4)


def replay_hybrid(rows, seconds: int, size: int):
    """The close-on-timer-or-count loop, replayed row by row in event time."""
    windows_, buffer, tick = [], [], None
    for row in sorted(rows, key=lambda r: (r[3], r[4])):
        bucket = int((row[3] - T0).total_seconds() // seconds)
        if tick is not None and bucket != tick and buffer:
            windows_.append(buffer)
            buffer = []
        tick = bucket
        buffer.append(row)
        if len(buffer) >= size:
            windows_.append(buffer)
            buffer = []
    return windows_ + ([buffer] if buffer else [])


@pytest.mark.parametrize("heavy_rows", [100_000, 5])
@pytest.mark.parametrize("seconds, size", [(10, 50), (60, 7), (600, 20)])
def test_hybrid_windows_equal_the_replayed_loop(stream, seconds, size, heavy_rows):
    got = windows.hybrid_windows(stream, f"{seconds} seconds", size, heavy_rows=heavy_rows)
    expected = set()
    for members in replay_hybrid(events(), seconds, size):
        start, end = members[0][3], members[-1][3]
        groups = defaultdict(list)
        for r in members:
            groups[r[0], r[1]].append(r[2])
        expected |= {
            (start, end, region, code, len(v), min(v), max(v))
            for (region, code), v in groups.items()
        }
    columns = ["window_start", "window_end", "region", "indicator", "count", "min", "max"]
    assert {tuple(r) for r in got.select(*columns).collect()} == expected


def test_ticks_may_start_off_the_epoch(stream):
    got = windows.hybrid_chunks(stream, "1 minute", 7, offset="7 seconds")
    assert {r.tick.second for r in got.select("tick").collect()} == {7}
    shifted = windows.tumbling(stream, "1 minute", offset="7 seconds")
    counts = defaultdict(int)
    for region, code, _, when, _ in events():
        minute = int(((when - T0).total_seconds() - 7) // 60)
        counts[T0 + timedelta(seconds=7 + 60 * minute), region, code] += 1
    columns = ["window_start", "region", "indicator", "count"]
    assert rows_of(shifted, *columns) == sorted((*k, n) for k, n in counts.items())


@pytest.mark.parametrize("heavy_rows", [100_000, 30])
def test_count_windows(stream, heavy_rows):
    got = windows.count_chunks(stream, 50, ["region"], heavy_rows=heavy_rows)
    sizes = got.groupBy("region", "chunk").count().collect()
    per_region = defaultdict(int)
    for r in events():
        per_region[r[0]] += 1
    for region, n in per_region.items():
        chunks = sorted((r.chunk, r["count"]) for r in sizes if r.region == region)
        assert [c for c, _ in chunks] == list(range((n + 49) // 50))
        assert all(k == 50 for _, k in chunks[:-1]) and sum(k for _, k in chunks) == n


def test_shard_may_be_the_entity(stream):
    got = windows.count_windows(stream, 50, ["region"])
    assert got.columns.count("region") == 1
    assert got.agg(F.sum("count")).first()[0] == len(events())


def test_tumbling_covers_every_row_once(stream):
    got = windows.tumbling(stream, "10 seconds")
    assert got.agg(F.sum("count")).first()[0] == len(events())
    widths = {r[0] for r in got.selectExpr("window_end - window_start").collect()}
    assert widths == {timedelta(seconds=10)}


@pytest.mark.parametrize("duration, slide", [(300, 30), (90, 60), (60, 60)])
def test_sliding_means_equal_brute_force(stream, duration, slide):
    got = windows.sliding_means(stream, "x", f"{duration} seconds", f"{slide} seconds")
    sums = defaultdict(list)
    for region, code, value, when, _ in events():
        if code != "x":
            continue
        second = (when - T0).total_seconds()
        start = second // slide * slide
        while start > second - duration:
            sums[T0 + timedelta(seconds=start), region].append(value)
            start -= slide
    rows = {(r.window_start, r.region): (r.avg_value, r.n) for r in got.collect()}
    assert set(rows) == set(sums)
    for key, values in sums.items():
        assert rows[key] == (pytest.approx(fmean(values)), len(values))


def test_top_per_window(stream):
    means = windows.sliding_means(stream, "x")
    top = windows.top_per_window(means, 2)
    best = defaultdict(list)
    for r in means.collect():
        best[r.window_start].append((-r.avg_value, r.region))
    expected = {
        (start, region, i + 1)
        for start, members in best.items()
        for i, (_, region) in enumerate(sorted(members)[:2])
    }
    assert set(rows_of(top, "window_start", "region", "rank")) == expected


def trailing_frame(spark, *seconds):
    rows = [(f"r{s}", "x", 1.0, T0 + timedelta(seconds=s), i) for i, s in enumerate(seconds)]
    return spark.createDataFrame(rows, SCHEMA)


def at(seconds):
    return F.lit(T0 + timedelta(seconds=seconds)).cast("timestamp_ntz")


def test_eviction(spark):
    df = trailing_frame(spark, 100, 200)
    assert tuple(windows.evicted_count(df, at(200), "10 seconds").first()) == (1, 1)
    assert rows_of(windows.trailing(df, at(200), "10 seconds"), "region") == [("r200",)]


def test_fresh_rows_stay(spark):
    df = trailing_frame(spark, 0, 5)
    assert windows.evicted_count(df, at(30), "60 seconds").first().evicted == 0


def test_row_on_the_edge_stays(spark):
    df = trailing_frame(spark, 190)
    assert windows.trailing(df, at(200), "10 seconds").count() == 1


def test_eviction_of_nothing(spark):
    df = trailing_frame(spark, 1).where("false")
    assert tuple(windows.evicted_count(df, at(200), "10 seconds").first()) == (0, 0)
