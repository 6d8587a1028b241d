from __future__ import annotations

from pyspark.sql import functions as F

import pytest

from panelworks.operators import shape
from panelworks.schema import (
    DEMOGRAPHIC_BASELINE,
    DEMOGRAPHIC_BOUNDS,
    DEMOGRAPHIC_INDICATORS,
    DEMOGRAPHIC_YEARS,
)
from tests.conftest import panel_rows, rows_of


def dimension(spark, n):
    names = [(f"item-{i:03d}", i) for i in range(n)]
    return spark.createDataFrame(names, "name string, place int").repartition(3)


def shards(spark, n, members):
    got = shape.assign_shards(dimension(spark, n), members, ["place"]).collect()
    out = {}
    for r in sorted(got, key=lambda r: r.place):
        out.setdefault(r.member, []).append(r.place)
    return out


def test_one_member_takes_all(spark):
    assert shards(spark, 3, ["only"]) == {"only": [0, 1, 2]}


def test_two_members_in_name_order(spark):
    assert shards(spark, 5, ["node-z", "node-a"]) == {"node-a": [0, 2, 4], "node-z": [1, 3]}


def test_even_and_disjoint(spark):
    got = shards(spark, 84, ["c", "a", "b"])
    assert [len(v) for v in got.values()] == [28, 28, 28]
    assert sorted(sum(got.values(), [])) == list(range(84))


def test_unknown_member_takes_everything(spark):
    items = dimension(spark, 5)
    assert shape.shard_of(items, ["a", "b"], "ghost", ["place"]).count() == 5
    assert rows_of(shape.shard_of(items, ["a", "b"], "b", ["place"]), "place") == [(1,), (3,)]


def test_full_grid_has_no_gaps(spark, panel_small):
    years = (2022, 2023)
    assert shape.gaps(panel_small, years, DEMOGRAPHIC_INDICATORS).count() == 0
    rows = shape.coverage(panel_small, years, DEMOGRAPHIC_INDICATORS).collect()
    assert {(r.expected, r.present, r.missing) for r in rows} == {(12, 12, 0)}


def test_grid_size():
    assert shape.grid_size(DEMOGRAPHIC_YEARS, DEMOGRAPHIC_INDICATORS) == 144


def test_gaps_list_each_missing_cell(spark, panel_small):
    part = panel_small.where(
        "not (region = 'Birch Vale' and year = 2022 and indicator = 'birth_rate')"
    ).where("not (region = 'Dune Plain' and year = 2023)")
    got = rows_of(shape.gaps(part, (2022, 2023), DEMOGRAPHIC_INDICATORS),
                  "region", "year", "indicator")
    expected = [("Birch Vale", 2022, "birth_rate")] + [
        ("Dune Plain", 2023, code) for code in DEMOGRAPHIC_INDICATORS
    ]
    assert got == sorted(expected)
    covered = shape.coverage(part, (2022, 2023), DEMOGRAPHIC_INDICATORS)
    assert dict(rows_of(covered, "region", "missing"))["Dune Plain"] == 6


def test_whole_grid_of_absent_years(spark, panel_small):
    assert shape.gaps(panel_small, DEMOGRAPHIC_YEARS, DEMOGRAPHIC_INDICATORS).count() == (
        4 * 144 - len(panel_rows())
    )


@pytest.mark.parametrize(
    "region, indicator, year, mu, sigma",
    [
        ("Москва", "population", 2010, 12_500_000.0 * (1 + 10 * 0.003), 800_000.0),
        ("Elsewhere", "population", 2000, 1_200_000.0, 800_000.0),
        ("A", "birth_rate", 2005, 11.5, 2.5),
        ("A", "birth_rate", 2006, 13.0, 2.5),
        ("A", "birth_rate", 2015, 13.0, 2.5),
        ("A", "birth_rate", 2016, 11.0, 2.5),
        ("A", "death_rate", 2004, 13.0, 2.0),
        ("A", "death_rate", 2010, 13.0 - 5 * 0.08, 2.0),
        ("A", "death_rate", 2020, 13.0 - 15 * 0.08 + 3.0, 2.0),
        ("A", "natural_growth", 2020, -1.5, 3.0),
        ("A", "migration_growth", 2020, 0.5, 2.0),
        ("A", "life_expectancy", 2004, 71.5, 3.5),
        ("A", "life_expectancy", 2021, 70.5 + 21 * 0.25 - 2.0, 3.5),
    ],
)
def test_expectation(spark, region, indicator, year, mu, sigma):
    df = spark.createDataFrame(
        [(region, indicator, year, mu + 2 * sigma)],
        "region string, indicator string, year int, value double",
    )
    got = shape.residuals(df, DEMOGRAPHIC_BASELINE).first()
    assert (got.mu, got.sigma) == (pytest.approx(mu), sigma)
    assert got.z == pytest.approx(2.0)


def test_unknown_indicator_has_no_expectation(spark):
    df = spark.createDataFrame(
        [("A", "none", 2000, 1.0)], "region string, indicator string, year int, value double"
    )
    assert shape.residuals(df, DEMOGRAPHIC_BASELINE).first().z is None


@pytest.mark.parametrize(
    "indicator, value, expected",
    [
        ("birth_rate", 1.0, 2.0),
        ("death_rate", 50.4, 50.0),
        ("life_expectancy", 39.0, 40.0),
        ("life_expectancy", 90.0, 85.0),
        ("population", 5.0, 10_000.0),
        ("population", 1e9, 1e9),
        ("natural_growth", -7.25, -7.3),
        ("natural_growth", 7.25, 7.3),
        ("migration_growth", 1.04, 1.0),
    ],
)
def test_clamp_round(spark, indicator, value, expected):
    df = spark.createDataFrame([(indicator, value)], "indicator string, value double")
    assert shape.clamp_round(df, DEMOGRAPHIC_BOUNDS).first().value == expected


def test_entities_without_a_row(spark, panel_small):
    entities = spark.createDataFrame([("Birch Vale",), ("Nowhere",), ("Nowhere",)], "region string")
    years = (2022, 2023)
    rows = shape.coverage(panel_small, years, DEMOGRAPHIC_INDICATORS, entities=entities)
    got = {r.region: (r.present, r.missing) for r in rows.collect()}
    assert got["Nowhere"] == (0, 12) and got["Birch Vale"] == (12, 0) and len(got) == 5
    missing = shape.gaps(panel_small, years, DEMOGRAPHIC_INDICATORS, entities=entities)
    assert {r.region for r in missing.collect()} == {"Nowhere"} and missing.count() == 12


def test_partition_by_key_keeps_the_order_inside_a_key(spark, panel_small):
    mixed = panel_small.orderBy(F.rand(3))
    parts = shape.partition_by_key(mixed, 3).select("region", "seq").rdd.glom().collect()
    assert len(parts) == 3
    seen = [{r.region for r in part} for part in parts]
    assert sum(len(s) for s in seen) == len(set().union(*seen)) == 4
    for part in parts:
        assert [r.seq for r in part] == sorted(r.seq for r in part)
