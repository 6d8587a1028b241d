from __future__ import annotations

import json

import pytest

from panelworks.operators.validate import error_categories, rejected_rows, valid_rows, validate
from panelworks.operators.validate_json import validate_json

SCHEMA = "region string, year long, indicator string, value double"
NAN, INF = float("nan"), float("inf")
GOOD = {"region": "Birch Vale", "year": 2020, "indicator": "birth_rate", "value": 10.5}
ABSENT = object()


def typed_errors(spark, **change):
    row = {**GOOD, **change}
    df = spark.createDataFrame([tuple(row.values())], SCHEMA)
    got = validate(df).first()
    assert got.valid == (not got.errors)
    return got.errors


def json_errors(spark, **change):
    row = {k: v for k, v in {**GOOD, **change}.items() if v is not ABSENT}
    df = spark.createDataFrame([(json.dumps(row, ensure_ascii=False),)], "value string")
    got = validate_json(df).first()
    assert got.valid == (not got.errors)
    return got.errors


ALLOWED = (
    '["population", "birth_rate", "death_rate", "natural_growth", "migration_growth", '
    '"life_expectancy"]'
)
BOTH = [
    ({}, []),
    ({"region": ""}, ["region: must be non-empty"]),
    ({"region": "   "}, ["region: must be non-empty"]),
    ({"region": "  "}, ["region: must be non-empty"]),
    ({"region": "X"}, ["region: length 1 not in [2, 100]"]),
    ({"region": "А" * 101}, ["region: length 101 not in [2, 100]"]),
    ({"region": "А" * 100}, []),
    ({"region": "Ян"}, []),
    ({"region": None}, ["region: must be string"]),
    ({"year": 1989}, ["year: 1989 not in [1990, 2030]"]),
    ({"year": 2031}, ["year: 2031 not in [1990, 2030]"]),
    ({"year": 0}, ["year: 0 not in [1990, 2030]"]),
    ({"year": 1990}, []),
    ({"year": 2030}, []),
    ({"year": None}, ["year: must be integer"]),
    ({"indicator": ""}, ["indicator: must be non-empty"]),
    ({"indicator": "unemployment"}, [f"indicator: 'unemployment' not in {ALLOWED}"]),
    ({"indicator": None}, ["indicator: must be string"]),
    ({"value": None}, ["value: must be number"]),
    ({"value": 0.0}, []),
    ({"value": 100.0}, []),
    ({"value": -1.0}, ["value: -1 not in [0.0, 100.0] for birth_rate"]),
    ({"value": 101.5}, ["value: 101.5 not in [0.0, 100.0] for birth_rate"]),
    (
        {"indicator": "population", "value": 999.0},
        ["value: 999 not in [1_000, 20_000_000] for population"],
    ),
    (
        {"indicator": "population", "value": 20_000_001.0},
        ["value: 20000001 not in [1_000, 20_000_000] for population"],
    ),
    ({"indicator": "population", "value": 1000.0}, []),
    (
        {"indicator": "life_expectancy", "value": 29.0},
        ["value: 29 not in [30.0, 100.0] for life_expectancy"],
    ),
    (
        {"indicator": "life_expectancy", "value": 101.0},
        ["value: 101 not in [30.0, 100.0] for life_expectancy"],
    ),
    (
        {"indicator": "natural_growth", "value": -101.0},
        ["value: -101 not in [-100.0, 100.0] for natural_growth"],
    ),
    (
        {"indicator": "migration_growth", "value": 101.0},
        ["value: 101 not in [-100.0, 100.0] for migration_growth"],
    ),
]


@pytest.fixture(scope="module")
def both_paths(spark):
    """Outcomes of all shared cases: one typed and one JSON run."""
    rows = [{**GOOD, **change} for change, _ in BOTH]
    typed = spark.createDataFrame(
        [(i, *r.values()) for i, r in enumerate(rows)], "i int, " + SCHEMA
    )
    texts = spark.createDataFrame(
        [(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)],
        "i int, value string",
    )
    return (
        {r.i: r.errors for r in validate(typed).collect()},
        {r.i: r.errors for r in validate_json(texts).collect()},
    )


@pytest.mark.parametrize("case", range(len(BOTH)))
def test_shared_cases(both_paths, case):
    typed, texts = both_paths
    assert typed[case] == BOTH[case][1]
    assert texts[case] == BOTH[case][1]


@pytest.mark.parametrize("value", [NAN, INF, -INF])
def test_not_finite(spark, value):
    assert typed_errors(spark, value=value) == ["value: must be finite number (not NaN/Inf)"]


@pytest.mark.parametrize(
    "change, errors",
    [
        ({"region": ABSENT}, ["region: missing"]),
        ({"region": 42}, ["region: must be string"]),
        ({"year": ABSENT}, ["year: missing"]),
        ({"year": "2020"}, ["year: must be integer"]),
        ({"year": 2020.0}, ["year: must be integer"]),
        ({"year": True}, ["year: 1 not in [1990, 2030]"]),
        ({"indicator": ABSENT}, ["indicator: missing"]),
        ({"indicator": 42}, ["indicator: must be string"]),
        ({"value": ABSENT}, ["value: missing"]),
        ({"value": "ten"}, ["value: must be number"]),
        ({"value": 7}, []),
        ({"value": True}, []),
        ({"value": [1]}, ["value: must be number"]),
    ],
)
def test_absent_and_mistyped_fields(spark, change, errors):
    assert json_errors(spark, **change) == errors


def test_malformed_text_is_rejected_not_lost(spark):
    texts = ['{"region": "Bir', "[1]", "null", "  ", '{"value": NaN}']
    got = validate_json(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert [(r.valid, r.errors) for r in got] == [(False, ["record: malformed"])] * 4


def test_column_that_does_not_exist_is_missing(spark):
    df = spark.createDataFrame([("Birch Vale", 2020)], "region string, year int")
    assert validate(df).first().errors == ["indicator: missing", "value: missing"]


def test_column_of_another_type(spark):
    df = spark.createDataFrame([(1, "2020", "birth_rate", "5")], "region int, year string, "
                               "indicator string, value string")
    assert validate(df).first().errors == [
        "region: must be string",
        "year: must be integer",
        "value: must be number",
    ]


def test_all_errors_accumulate_in_field_order(spark):
    errors = typed_errors(spark, region="", year=1500, indicator="unknown", value=NAN)
    assert [e.split(":")[0] for e in errors] == ["region", "year", "indicator", "value"]


def test_all_indicators_valid(spark):
    values = {
        "birth_rate": 10.5,
        "death_rate": 13.0,
        "natural_growth": -2.5,
        "migration_growth": 1.5,
        "life_expectancy": 75.0,
        "population": 1_500_000.0,
    }
    df = spark.createDataFrame([("Birch Vale", 2020, k, v) for k, v in values.items()], SCHEMA)
    assert validate(df).where("valid").count() == 6


def test_batch_keeps_length_and_order(spark):
    rows = [("Birch Vale", y, "birth_rate", 10.0) for y in (2020, 1800, 2021)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.valid for r in validate(df).collect()] == [True, False, True]
    assert validate(df.where("false")).count() == 0


def test_split_sizes_and_shape(spark, panel_small):
    bad = panel_small.limit(3).selectExpr("* except (year)", "1800L as year")
    mixed = panel_small.unionByName(bad)
    assert valid_rows(mixed).count() == 48
    rejected = rejected_rows(mixed)
    assert rejected.count() == 3
    assert rejected.columns == ["record", "errors"]
    assert rejected.first().record.year == 1800


def test_all_rejected_keeps_the_schema(spark, panel_small):
    none = valid_rows(panel_small.selectExpr("* except (year)", "1800L as year"))
    assert none.count() == 0 and set(none.columns) == set(panel_small.columns)


def test_error_categories_top(spark):
    rows = [("", 1800, "x", 1.0), ("Birch Vale", 1800, "birth_rate", 1.0), ("M", 2000, "x", 1.0)]
    top = error_categories(validate(spark.createDataFrame(rows, SCHEMA)))
    assert [tuple(r) for r in top.collect()] == [("indicator", 2), ("region", 2), ("year", 2)]


def test_good_rows_need_no_shuffle(spark, panel_small):
    plan = validate(panel_small)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
