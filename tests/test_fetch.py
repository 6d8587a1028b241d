"""The fetch source: what is pushed, what is read, and that rows are those of a plain filter."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks import sinks, sources
from panelworks.sources import fetch
from panelworks.operators import reports
from panelworks.schema import FilterSpec
from tests.conftest import panel_rows

SCHEMA = (
    "region string, federal_district string, year bigint, indicator string, value double, "
    "collected_at timestamp"
)


@pytest.fixture()
def stored(spark, tmp_path):
    rows = spark.createDataFrame(
        [*panel_rows(), ("Nowhere", None, 2023, "birth_rate", float("nan"), None)], SCHEMA
    )
    path = str(tmp_path / "by_indicator")
    sinks.write_by_indicator(rows, path)
    return rows, path


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString().replace("RuntimeFilters", "")


@pytest.mark.parametrize(
    "want",
    [
        FilterSpec(),
        FilterSpec("birth_rate"),
        FilterSpec("birth_rate", year_from=2023),
        FilterSpec("death_rate", 2000, 2022, panel_rows()[0][0]),
        FilterSpec("none of them"),
    ],
)
def test_rows_are_those_of_a_plain_filter(spark, stored, want):
    rows, path = stored
    got = sources.fetch_from(spark, path, rows.schema, want)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.where(reports.matches(want)).collect()))
    assert "Filter" not in plan_of(got)


def test_files_of_other_folders_are_not_opened(spark, stored, tmp_path):
    rows, path = stored
    for broken in (tmp_path / "by_indicator").glob("indicator=death_rate/*.parquet"):
        broken.write_bytes(b"not a parquet file")
    got = sources.fetch_from(spark, path, rows.schema, FilterSpec("birth_rate", year_from=2023))
    assert got.count() == rows.where("indicator = 'birth_rate' and year >= 2023").count() > 0
    with pytest.raises(Exception, match="(?i)parquet"):
        sources.fetch_from(spark, path, rows.schema).count()


def test_filters_on_floating_point_stay_with_spark(spark, stored):
    """NaN is larger than all numbers to Spark, and not comparable to Arrow."""
    rows, path = stored
    got = sources.fetch_from(spark, path, rows.schema).where("value > 13 or year = 1")
    assert got.count() == rows.where("value > 13 or year = 1").count()
    got = sources.fetch_from(spark, path, rows.schema).where("value > 13")
    assert got.count() == rows.where("value > 13").count() and "Filter" in plan_of(got)
    some = sources.fetch_from(spark, path, rows.schema).where(
        "federal_district is null or region like 'N%'"
    )
    assert some.count() == 1


def test_batches_are_bounded(spark, tmp_path):
    path = str(tmp_path / "many")
    spark.range(5000).coalesce(1).write.parquet(path)
    schema = T.StructType([T.StructField("id", T.LongType())])
    reader = fetch._Reader(path, "parquet", 1000, schema)
    (file,) = reader.partitions()
    sizes = [b.num_rows for b in reader.read(file)]
    assert sum(sizes) == 5000 and max(sizes) <= 1000
    got = sources.fetch_from(spark, path, schema, form="parquet").where(F.col("id") % 2 == 0)
    assert got.count() == 2500


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.range(100).selectExpr("id", "cast(id % 3 as string) k").write.json(path)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("k", T.StringType())])
    got = sources.fetch_from(spark, path, schema, form="json").where("k = '1' and id < 50")
    assert sorted(r.id for r in got.collect()) == [i for i in range(50) if i % 3 == 1]
