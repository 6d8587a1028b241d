"""Hot groups: the range path must give what a plain window gives."""

from __future__ import annotations

import math
import random
import statistics
import struct
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelworks.operators import ranking
from panelworks.operators.aggregate import group_stats, median_stats, run_stats
from panelworks.schema import PanelSpec


def skewed(n: int = 3000, seed: int = 7) -> list[tuple]:
    """A third of all rows in one group; null keys; many equal order values."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", None])
        rows.append((key, rng.randrange(5), i, round(rng.uniform(0, 50), 1)))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def skewed_df(spark):
    return spark.createDataFrame(skewed(), "k string, t int, seq long, v double").repartition(5)


def expected_numbers(rows) -> dict[int, int]:
    groups = defaultdict(list)
    for k, t, seq, _ in rows:
        groups[k].append((t, seq))
    return {
        seq: i + 1 for members in groups.values() for i, (_, seq) in enumerate(sorted(members))
    }


@pytest.mark.parametrize("heavy_rows", [10_000, 800, 50])
def test_row_numbers_do_not_depend_on_the_path(spark, skewed_df, heavy_rows):
    got = ranking.number_rows(skewed_df, ["k"], ["t", "seq"], "n", heavy_rows)
    assert {r.seq: r.n for r in got.collect()} == expected_numbers(skewed())
    assert set(got.columns) == {"k", "t", "seq", "v", "n"}


@pytest.mark.parametrize("heavy_rows", [10_000, 100])
def test_global_row_numbers(skewed_df, heavy_rows):
    got = ranking.number_rows(skewed_df, [], ["t", "seq"], "n", heavy_rows)
    order = sorted((t, seq) for _, t, seq, _ in skewed())
    assert {r.seq: r.n for r in got.collect()} == {seq: i + 1 for i, (_, seq) in enumerate(order)}


def test_heavy_groups_are_found(skewed_df):
    assert [tuple(r) for r in ranking.heavy_groups(skewed_df, ["k"], 900).collect()] == [
        ("hot", 1000)
    ]
    assert ranking.heavy_groups(skewed_df, ["k"], 100_000).count() == 0


@pytest.mark.parametrize("heavy_rows", [10_000, 800, 20])
def test_exact_median_on_both_paths(skewed_df, heavy_rows):
    spec = PanelSpec(value="v", scale=1)
    got = {
        r.k: (r.sum, r.avg, r.min, r.max, r["count"], r.p50)
        for r in median_stats(skewed_df, ["k"], spec, heavy_rows=heavy_rows).collect()
    }
    groups = defaultdict(list)
    for k, _, _, v in skewed():
        groups[k].append(v)
    assert set(got) == set(groups)
    for k, values in groups.items():
        total, avg, low, high, count, p50 = got[k]
        assert (low, high, count) == (min(values), max(values), len(values))
        assert total == pytest.approx(sum(values))
        assert avg == pytest.approx(statistics.fmean(values), abs=0.0051)
        assert p50 == pytest.approx(statistics.median(values), abs=0.0051)


@pytest.mark.parametrize("heavy_rows", [10_000, 40])
def test_statistics_from_value_runs(skewed_df, heavy_rows):
    spec = PanelSpec(value="v", scale=1)
    runs = ranking.value_runs(skewed_df, ["k"], "v")
    got = run_stats(runs, ["k"], "n", spec, heavy_rows=heavy_rows).collect()
    want = median_stats(skewed_df, ["k"], spec).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_order_images(spark):
    rng = random.Random(3)
    inf = float("inf")
    values = [0.0, -0.0, 5e-324, -5e-324, 1.0, -1.0, inf, -inf, 1e308, 0.1, -0.1, 2.0**53]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(300)]
    values = [v for v in values if not math.isnan(v)] + [float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    image = ranking.order_image(F.col("v"))
    got = df.select("v", image.alias("i"), ranking.image_value(image).alias("back")).collect()
    for r in got:
        assert r.back == r.v or (math.isnan(r.back) and math.isnan(r.v))
    images = dict(zip(map(repr, values), [r.i for r in got], strict=True))
    assert images["0.0"] == images["-0.0"]
    ordered = sorted({r.i: r.v for r in got}.items())
    assert [v for _, v in ordered[:-1]] == sorted(v for _, v in ordered[:-1])
    assert math.isnan(ordered[-1][1])


@pytest.mark.parametrize("count", [1, 2, 3, 50, 51])
def test_radix_selected_medians(spark, count):
    """Even and odd counts, signs, infinities, NaN, equal values and a null group."""
    rng = random.Random(count)
    inf, nan = float("inf"), float("nan")
    pool = [0.0, -0.0, inf, -inf, 1e300, -1e-300, 1.5, 1.5, -2.25, 7.0, 3.0, -8.0]
    groups = {
        "plain": [rng.uniform(-9, 9) for _ in range(count)],
        None: [float(rng.choice(pool)) for _ in range(count)],
        "nan": [rng.choice([nan, 1.0]) for _ in range(count)],
        "same": [4.5] * count,
    }
    rows = [(k, v, rng.randrange(1, 3)) for k, own in groups.items() for v in own]
    df = spark.createDataFrame([*rows, ("plain", None, 1)], "k string, v double, n bigint")
    got = {r.k: r.m for r in ranking.heavy_median(df, ["k"], "v", "n", "m").collect()}
    for k in groups:
        own = [v for key, v, n in rows if key == k for _ in range(n)]
        own.sort(key=lambda v: (math.isnan(v), v))
        want = (own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2
        assert got[k] == want or (math.isnan(got[k]) and math.isnan(want)), k
    assert len(got) == len(groups)


def test_rows_of_a_hot_group_are_not_sorted(skewed_df):
    runs = ranking.value_runs(skewed_df, ["k"], "v")
    plan = ranking.heavy_median(runs, ["k"], "v", "n", "m")._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert "rangepartitioning" not in text.lower() and "RepartitionByExpression" not in text
    ordered = [line for line in text.splitlines() if "Window [" in line]
    assert len(ordered) == 4 and all("_bin" in line for line in ordered)
    assert not any("Sort [" in line for line in text.splitlines())


def test_many_copies_of_one_value(spark):
    rows = [("hot", 5.0)] * 900 + [("hot", float(i)) for i in range(101)]
    df = spark.createDataFrame(rows, "k string, v double")
    spec = PanelSpec(value="v")
    stats = median_stats(df, ["k"], spec, heavy_rows=10).first()
    assert stats.p50 == statistics.median([v for _, v in rows])


@pytest.mark.parametrize("heavy_rows", [10_000, 5])
def test_statistics_read_the_source_once(spark, tmp_path, heavy_rows):
    path = str(tmp_path / "rows")
    spark.createDataFrame(skewed(300), "k string, t int, seq long, v double").write.parquet(path)
    plan = median_stats(spark.read.parquet(path), ["k"], PanelSpec(value="v"), heavy_rows=heavy_rows)
    assert path not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert path not in str(plan.inputFiles())


def test_scaled_sums_keep_what_is_not_finite(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("n", nan), ("n", 1.0), ("i", inf), ("i", 2.0), ("b", inf), ("b", -inf), ("z", None)]
    rows += [("big", 1e17), ("big", 1.25), ("huge", 1e300), ("s", 0.1), ("s", 0.2), ("s", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    spec = PanelSpec(value="v", scale=2)
    for heavy_rows in (100, 1):
        got = {r.k: (r.sum, r.avg) for r in median_stats(df, ["k"], spec, heavy_rows=heavy_rows).collect()}
        assert all(str(x) == "nan" for x in (*got["n"], *got["b"]))
        assert got["i"] == (inf, inf) and got["z"] == (None, None)
        assert got["big"][0] == 1e17 and got["huge"][0] >= 1e299
        assert got["s"] == (0.3, 0.15)
    plain = {r.k: r.sum for r in group_stats(df, ["k"], spec).collect()}
    assert plain["big"] == 1e17 + 1.25 and plain["s"] == 0.3 and str(plain["n"]) == "nan"
