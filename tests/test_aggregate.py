from __future__ import annotations

import numpy as np
import pytest

from panelworks.operators import aggregate, reports
from panelworks.schema import DEMOGRAPHIC_LABELS, FilterSpec, PanelSpec
from tests.conftest import rows_of

CASES = "region string, indicator string, value double"


def stats_of(spark, values):
    df = spark.createDataFrame([("A", "x", float(v)) for v in values], CASES)
    return aggregate.median_stats(df, ["region", "indicator"]).collect()


def test_odd_group(spark):
    (row,) = stats_of(spark, [10, 11, 12, 13, 14])
    assert tuple(row) == ("A", "x", 60.0, 12.0, 10.0, 14.0, 5, 12.0)


@pytest.mark.parametrize(
    "values, p50", [([1, 2, 3, 4], 2.5), ([100, 50, 75], 75.0), ([42], 42.0), ([1, 1, 9], 1.0)]
)
def test_medians(spark, values, p50):
    assert stats_of(spark, values)[0].p50 == p50


def test_three_groups_and_none(spark):
    rows = [
        ("Birch Vale", "birth", 10.0),
        ("Birch Vale", "death", 13.0),
        ("СПб", "birth", 9.0),
        ("СПб", "birth", 9.5),
    ]
    df = spark.createDataFrame(rows, CASES)
    got = aggregate.median_stats(df, ["region", "indicator"])
    assert got.count() == 3
    assert rows_of(got, "region", "indicator", "p50")[2] == ("СПб", "birth", 9.25)
    assert aggregate.median_stats(df.where("false"), ["region", "indicator"]).count() == 0


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([("A", "x", -0.125), ("B", "x", 0.125), ("C", "x", 1.005)], CASES)
    got = aggregate.median_stats(df, ["region"])
    assert [r[1] for r in rows_of(got, "region", "p50")] == [-0.13, 0.13, 1.0]


def test_group_stats_sorted_with_null_group(spark):
    rows = [(None, "x", 1.0), ("B", "x", 2.0), ("B", "x", 3.0), ("A", "x", 5.0)]
    df = spark.createDataFrame(rows, "federal_district string, indicator string, value double")
    got = aggregate.group_stats(df, ["federal_district", "indicator"]).collect()
    assert [(r.federal_district, r.sum, r.avg, r["count"]) for r in got] == [
        (None, 1.0, 1.0, 1),
        ("A", 5.0, 5.0, 1),
        ("B", 5.0, 2.5, 2),
    ]


def test_decimal_sums_are_exact(spark):
    df = spark.createDataFrame([("A", "x", 0.1)] * 10, CASES)
    got = aggregate.median_stats(df, ["region"], PanelSpec(scale=1)).first()
    assert got.sum == 1.0 and got.avg == 0.1


def test_kpis(panel_small):
    total = aggregate.kpi_total(panel_small, "population").first()
    assert total.year == 2023 and total.total_in_units == pytest.approx(17.3, abs=1e-5)
    mean = aggregate.kpi_mean(panel_small, "life_expectancy").first()
    assert mean.avg == pytest.approx((79 + 77.5 + 76 + 74) / 4 + 0.1)
    assert aggregate.kpi_negative(panel_small, "natural_growth").first().n == 4


def test_kpi_labels(panel_small):
    kpi = aggregate.kpi_total(panel_small, "population")
    assert reports.total_label(kpi).first().label == "17.3 млн (за 2023)"
    kpi = aggregate.kpi_mean(panel_small, "life_expectancy")
    assert reports.mean_label(kpi).first().label == "76.7 лет (за 2023)"
    kpi = aggregate.kpi_negative(panel_small, "natural_growth")
    assert reports.count_label(kpi).first().label == "4 регионов"


def test_kpi_labels_without_the_indicator(panel_small):
    for label, kpi in [
        (reports.total_label, aggregate.kpi_total),
        (reports.mean_label, aggregate.kpi_mean),
        (reports.count_label, aggregate.kpi_negative),
    ]:
        assert label(kpi(panel_small, "nothing")).first().label == "—"


def test_top_means(panel_small):
    top = aggregate.top_means(panel_small, "birth_rate").collect()
    assert [r.region for r in top] == ["Dune Plain", "Aspen Ridge", "Birch Vale",
                                       "Cedar Coast"]
    assert [r.n for r in top] == [2, 2, 2, 2]
    assert aggregate.top_means(panel_small, "nothing").count() == 0


def test_top_means_ignores_null_values(spark):
    df = spark.createDataFrame([("A", "x", None), ("B", "x", 1.0)], CASES)
    assert [r.region for r in aggregate.top_means(df, "x").collect()] == ["B"]


@pytest.mark.parametrize("seed", range(3))
def test_histogram_equals_numpy(spark, seed):
    values = np.round(np.random.default_rng(seed).normal(11, 2, 500), 1)
    df = spark.createDataFrame([("A", "x", float(v)) for v in values], CASES)
    got = aggregate.histogram(df, "x").collect()
    counts, edges = np.histogram(values, bins=40)
    assert [r.n for r in got] == counts.tolist()
    assert [r.low for r in got] == pytest.approx(edges[:-1].tolist())
    assert [r.high for r in got] == pytest.approx(edges[1:].tolist())


def test_histogram_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([("A", "x", 3.0)] * 5, CASES)
    got = aggregate.histogram(df, "x").collect()
    counts, _ = np.histogram([3.0] * 5, bins=40)
    assert [r.n for r in got] == counts.tolist()
    assert aggregate.histogram(df, "y").count() == 0


def test_average_since(panel_small):
    got = aggregate.average_since(panel_small, 2023, limit=3).collect()
    assert len(got) == 3 and all(r.n == 1 for r in got)


def test_dynamics_in_year_order(panel_small):
    got = aggregate.dynamics(panel_small, "birth_rate").collect()
    assert len(got) == 8 and [r.year for r in got] == sorted(r.year for r in got)
    assert aggregate.dynamics(panel_small, "nothing").count() == 0


# --- filters -----------------------------------------------------------------


@pytest.mark.parametrize(
    "want, hit",
    [
        (FilterSpec(), True),
        (FilterSpec("", 0, 0, ""), True),
        (FilterSpec(indicator="birth_rate"), True),
        (FilterSpec(indicator="death_rate"), False),
        (FilterSpec(region="X"), True),
        (FilterSpec(region="Y"), False),
        (FilterSpec(year_from=2010, year_to=2020), True),
        (FilterSpec(year_from=2016), False),
        (FilterSpec(year_to=2010), False),
        (FilterSpec(year_from=2015), True),
        (FilterSpec(year_to=2015), True),
        (FilterSpec(year_from=2010), True),
        (FilterSpec(year_to=2020), True),
        (FilterSpec("birth_rate", 2015, 2015, "X"), True),
    ],
)
def test_filter(spark, want, hit):
    df = spark.createDataFrame([("X", "birth_rate", 2015)], "region string, indicator string, "
                               "year int")
    assert (df.where(reports.matches(want)).count() == 1) is hit


def test_fetch_shape(spark):
    df = spark.sql(
        "select 'A' region, 'D' federal_district, 2000L year, 'x' indicator, 1.5D value, "
        "timestamp'2024-01-01 00:00:00.123456' collected_at, 'more' extra"
    )
    got = reports.fetch(df, FilterSpec())
    assert dict(got.dtypes)["year"] == "int" and "extra" not in got.columns
    assert got.first().collected_at.microsecond == 123000


def test_fetch_metrics(panel_small):
    got = reports.fetch_metrics(reports.fetch(panel_small, FilterSpec()), batch_rows=10).first()
    assert (got.rows, got.batches) == (48, 5)
    none = reports.fetch_metrics(reports.fetch(panel_small, FilterSpec("none"))).first()
    assert (none.rows, none.batches) == (0, 0)


def test_arrow_footprint(panel_small):
    fetched = reports.fetch(panel_small.coalesce(1), FilterSpec())
    got = reports.arrow_footprint(fetched, batch_rows=10).first()
    assert (got.rows, got.batches) == (48, 5) and got.arrow_bytes > 48 * 8
    none = reports.arrow_footprint(reports.fetch(panel_small, FilterSpec("none"))).first()
    assert tuple(none) == (0, 0, 0)


def test_panel_filter_drops_null_groups(spark, panel_small):
    nulls = panel_small.selectExpr("* except (federal_district)", "null as federal_district")
    both = panel_small.unionByName(nulls)
    assert reports.panel_filter(both, (2022, 2022), ["Inland", "Upland"]).count() == 12


def test_slices(panel_small):
    got = reports.year_slice(panel_small, "population", 2023).collect()
    assert [r.value for r in got] == sorted((r.value for r in got), reverse=True)
    assert reports.year_slice(panel_small, "population", 1999).count() == 0
    assert reports.year_slice(panel_small, "nothing", 2023).count() == 0
    top = reports.top_slice(panel_small, "life_expectancy", 2023, 2).collect()
    assert [tuple(r) for r in top] == [("Birch Vale", 79.1), ("Cedar Coast", 77.6)]


def test_score(spark):
    def scored(*values):
        rows = [(f"r{i}", "D", 2000, "x", float(v)) for i, v in enumerate(values)]
        df = spark.createDataFrame(
            rows, "region string, federal_district string, year int, indicator string, value double"
        )
        return [r.score for r in reports.top_scored(df, "x", 2000).collect()]

    assert scored(10, 20, 15) == [1.0, 0.5, 0.0]
    assert scored(7, 7) == [0.5, 0.5]
    assert len(scored(*range(30))) == 20 and min(scored(*range(30))) == 0.0


def test_top_stats(panel_small):
    got = reports.top_stats(panel_small, "birth_rate", 2023, 3).first()
    assert (got.median, got.min, got.max) == (10.1, 9.1, 11.1)


def test_labels(panel_small):
    got = dict(
        rows_of(reports.with_labels(panel_small, {"birth_rate": "Births"}), "indicator", "label")
    )
    assert got["birth_rate"] == "Births" and got["population"] == "population"
    named = reports.with_labels(panel_small, DEMOGRAPHIC_LABELS).where("label = indicator")
    assert named.count() == 0


def test_distinct_and_extent(panel_small):
    years = reports.sorted_distinct(panel_small, "year").collect()
    assert [r.year for r in years] == [2022, 2023]
    assert tuple(aggregate.extent(panel_small).first()) == (48, 2022, 2023)


def test_first_rows(panel_small):
    got = reports.first_rows(panel_small, 5).collect()
    assert [r.seq for r in got] == sorted(r.seq for r in panel_small.collect())[:5]


def test_means_of_records_without_the_columns(spark):
    from panelworks.operators.aggregate import top_means
    from panelworks.operators.windows import sliding_means, top_per_window

    other = spark.createDataFrame([(1,)], "x int")
    assert top_means(other, "birth_rate").count() == 0
    assert top_per_window(sliding_means(other, "birth_rate")).count() == 0
