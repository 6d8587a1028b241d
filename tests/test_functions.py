from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelworks import functions as P


def evaluate(spark, column, value, kind="double"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "value, text",
    [(101.0, "101"), (0.0, "0"), (-2.5, "-2.5"), (2e7, "20000000"), (0.1, "0.1"), (100.25, "100.25"),
     (1e-7, "0.0000001"), (123456789.125, "123456789.125")],
)
def test_plain_number(spark, value, text):
    assert evaluate(spark, P.plain_number(F.col("x")), value) == text


@pytest.mark.parametrize(
    "value, digits, expected",
    [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13), (None, 2, None)],
)
def test_round_to(spark, value, digits, expected):
    assert evaluate(spark, P.round_to(F.col("x"), digits), value) == expected


@pytest.mark.parametrize(
    "value, finite", [(1.0, True), (math.nan, False), (math.inf, False), (-math.inf, False),
                      (None, None)]
)
def test_is_finite(spark, value, finite):
    assert evaluate(spark, P.is_finite(F.col("x")), value) is finite


@pytest.mark.parametrize(
    "text, blank",
    [("", True), (" ", True), ("\t\n\r\x0b\x0c", True), ("  　\u0085", True),
     ("a", False), (" a ", False), (" Я", False), ("​", False), (None, None)],
)
def test_is_blank(spark, text, blank):
    assert evaluate(spark, P.is_blank(F.col("x")), text, "string") is blank


def test_clamp_ignores_missing_bounds(spark):
    none = F.lit(None).cast("double")
    assert evaluate(spark, P.clamp(F.col("x"), none, F.lit(3.0)), 5.0) == 3.0
    assert evaluate(spark, P.clamp(F.col("x"), F.lit(7.0), none), 5.0) == 7.0
    assert evaluate(spark, P.clamp(F.col("x"), none, none), 5.0) == 5.0


def test_score_ends_and_middle(spark):
    def score(v, low, high):
        return evaluate(spark, P.min_max_score(F.col("x"), F.lit(low), F.lit(high)), v)

    assert [score(v, 0.0, 10.0) for v in (0.0, 10.0, 5.0)] == [0.0, 1.0, 0.5]
    assert score(4.0, 4.0, 4.0) == 0.5


def test_time_texts(spark):
    row = spark.sql("select timestamp'2024-01-02 03:04:05.678901' t").select(
        P.rfc3339(F.col("t")).alias("r"),
        P.name_stamp(F.col("t")).alias("n"),
        P.truncated_to_millis(F.col("t")).alias("m"),
    ).first()
    assert row.r == "2024-01-02T03:04:05.678901Z"
    assert row.n == "20240102_030405_678901"
    assert row.m.microsecond == 678000


def test_category_and_lookup(spark):
    assert evaluate(spark, P.error_category(F.col("x")), "year: 5: x", "string") == "year"
    assert evaluate(spark, P.lookup(F.col("x"), {"a": 1}), "b", "string") is None
    assert evaluate(spark, P.label_of(F.col("x"), {}), "b", "string") == "b"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10_000, 10_000).map(lambda i: i / 100), min_size=1, max_size=40))
def test_exact_sum_is_the_decimal_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    exact = sum((Decimal(str(v)) for v in values), Decimal(0))
    row = df.select("x").agg(
        P.total(F.col("x"), 2).alias("s"), P.round_to(P.mean(F.col("x"), 2), 2).alias("m")
    ).first()
    assert row.s == float(exact)
    half_up = (exact / len(values)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert abs(row.m - float(half_up)) <= 0.01


def test_rfc3339_is_utc_in_any_session(spark):
    from datetime import datetime, timezone

    from panelworks.functions import rfc3339

    df = spark.createDataFrame([(datetime(2024, 1, 1, tzinfo=timezone.utc),)], "t timestamp")
    df = df.withColumn("n", F.lit("2024-01-01 00:00:00.000001").cast("timestamp_ntz"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Moscow")
        row = df.select(rfc3339(F.col("t")).alias("t"), rfc3339(F.col("n")).alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.t == "2024-01-01T00:00:00.000000Z"
    assert row.n == "2024-01-01T00:00:00.000001Z"
