from __future__ import annotations

from datetime import datetime

import pytest

from panelworks.operators.clean import clean, clean_report, keep_first, typed, without_service_rows
from panelworks.schema import PanelSpec
from tests.conftest import rows_of

SCHEMA = (
    "region string, federal_district string, year long, indicator string, value double, "
    "collected_at timestamp, seq long"
)
T0 = datetime(2024, 1, 1)
NAN, INF = float("nan"), float("inf")


def frame(spark, *rows):
    """Rows (region, year, indicator, value); input order is list order."""
    full = [(r, None, y, i, v, T0, n) for n, (r, y, i, v) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def kept(df):
    return rows_of(df, "region", "year", "indicator", "value")


@pytest.mark.parametrize("missing", [0, 1, 2, 3])
def test_null_in_each_required_field_drops_the_row(spark, missing):
    row = ["A", 2000, "x", 1.0]
    row[missing] = None
    assert kept(clean(frame(spark, tuple(row), ("B", 2000, "x", 2.0)))) == [("B", 2000, "x", 2.0)]


def test_null_district_is_kept(spark):
    assert clean(frame(spark, ("A", 2000, "x", 1.0))).first().federal_district is None


def test_first_copy_wins(spark):
    df = frame(spark, ("A", 2000, "x", 9.0), ("A", 2000, "x", 1.0), ("A", 2001, "x", 3.0))
    assert kept(clean(df)) == [("A", 2000, "x", 9.0), ("A", 2001, "x", 3.0)]


def test_key_whose_first_copy_is_nan_is_lost(spark):
    df = frame(spark, ("A", 2000, "x", NAN), ("A", 2000, "x", 1.0))
    assert kept(clean(df)) == []


def test_null_first_copy_does_not_count(spark):
    df = frame(spark, ("A", 2000, "x", None), ("A", 2000, "x", 1.0))
    assert kept(clean(df)) == [("A", 2000, "x", 1.0)]


def test_year_bounds_are_inclusive(spark):
    df = frame(spark, *[("A", y, "x", 1.0) for y in (1989, 1990, 2030, 2031)])
    assert [r[1] for r in kept(clean(df))] == [1990, 2030]


def test_infinite_values_are_dropped(spark):
    df = frame(spark, ("A", 2000, "x", INF), ("B", 2000, "x", -INF), ("C", 2000, "x", 0.0))
    assert [r[0] for r in kept(clean(df))] == ["C"]


def test_types_after_cleaning(spark):
    types = dict(clean(frame(spark, ("A", 2000, "x", 1.0))).dtypes)
    assert types["year"] == "int" and types["value"] == "double"


def test_report_adds_up(spark):
    df = frame(
        spark,
        ("A", 2000, "x", 1.0),
        ("A", 2000, "x", 2.0),
        ("B", 1980, "x", NAN),
        ("C", 2000, "x", NAN),
        (None, 2000, "x", 1.0),
        ("D", 2000, "x", None),
        ("D", 2000, "x", 4.0),
    )
    report = clean_report(df).first().asDict()
    assert report == {
        "rows_before": 7,
        "rows_after": 2,
        "rows_dropped": 5,
        "missing_required": 2,
        "later_copies": 1,
        "year_out_of_range": 1,
        "not_finite": 1,
    }
    assert report["rows_after"] == clean(df).count()


def test_report_of_an_empty_frame(spark):
    report = clean_report(frame(spark, ("A", 1, "x", 1.0)).where("false")).first()
    assert report.rows_before == report.rows_after == report.rows_dropped == 0


def test_dedup_needs_an_order(spark):
    with pytest.raises(ValueError):
        keep_first(frame(spark, ("A", 1, "x", 1.0)), PanelSpec(order=("nowhere",)))


def test_dedup_limits_before_the_shuffle(spark, panel_small):
    plan = keep_first(panel_small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_service_rows(spark):
    df = frame(spark, ("A", 1, "_agg_x", 1.0), ("A", 1, "x_agg_", 1.0), ("A", 1, None, 1.0))
    assert [r[2] for r in kept(without_service_rows(df))] == ["x_agg_"]
    other = spark.range(3)
    assert without_service_rows(other).count() == 3


def test_dedup_needs_the_unique_order_column(spark, panel_small):
    with pytest.raises(ValueError):
        keep_first(panel_small.drop("seq"))


def test_report_agrees_with_clean_on_null_times(spark):
    rows = [("A", None, 2020, "x", NAN, None, 1), ("A", None, 2020, "x", 1.0, T0, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    report = clean_report(df).first()
    assert clean(df).count() == report.rows_after == 1


def test_years_out_of_int_range_become_null(spark):
    df = spark.createDataFrame([("A", None, 99_999_999_999, "x", 1.0, T0, 1)], SCHEMA)
    assert [r.year for r in typed(df).collect()] == [None]
