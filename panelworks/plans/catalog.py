"""Registered queries and, next to each, the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks import sinks, sources, streaming
from panelworks.functions import is_finite, utc_naive
from panelworks.operators import aggregate, clean, increment, reports, shape, validate, windows
from panelworks.operators.validate_json import validate_json
from panelworks.plans import adapters, analyze
from panelworks.plans.adapters import (
    CUSTOMERS_SQL,
    DIRTY_SQL,
    EV_SQL,
    JSON_SQL,
    OBS_SQL,
    ORDERS_SQL,
    SHIPMENTS_SQL,
    SPEC,
)
from panelworks.schema import (
    DIMENSION_SCHEMA,
    RECORD_SCHEMA,
    Baseline,
    FilterSpec,
    Growth,
    Range,
    RuleSet,
    Slope,
    Step,
)
from panelworks.session import scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


# Rules that bite on the star-schema panel.
RULES = RuleSet(
    indicators=("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"),
    ranges={
        "1-URGENT": Range(5_000.0, 400_000.0),
        "2-HIGH": Range(0.0, 450_000.0),
        "3-MEDIUM": Range(10_000.0, 490_000.0, "[10_000, 490_000]"),
    },
    year_range=(1996, 2000),
    name_length=(2, 8),
)
ALLOWED_SQL = '["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]'

WITH_OBS = f"WITH obs AS ({OBS_SQL})"
WITH_ORDERS = f"WITH obs AS ({ORDERS_SQL})"
WITH_EV = f"WITH ev AS ({EV_SQL})"
WITH_DIRTY = f"WITH dirty AS ({DIRTY_SQL})"


def sum2(x: str = "value") -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


def avg2(x: str = "value") -> str:
    return f"({sum2(x)} / count({x}))"


def r(x: str, digits: int = 2) -> str:
    factor = 10**digits
    return f"(round(({x}) * CAST({factor} AS DOUBLE)) / CAST({factor} AS DOUBLE))"


def median(x: str = "value") -> str:
    lower = f"list_sort(list({x}))[CAST((count({x}) + 1) // 2 AS INTEGER)]"
    upper = f"list_sort(list({x}))[CAST(count({x}) // 2 + 1 AS INTEGER)]"
    return f"(({lower} + {upper}) / 2)"


STATS_SQL = f"""{r(sum2())} AS sum, {r(avg2())} AS avg, min(value) AS min, max(value) AS max,
    count(*) AS count, {r(median())} AS p50"""

GROUP_STATS_SQL = f"""{sum2()} AS sum, {r(avg2())} AS avg, min(value) AS min, max(value) AS max,
    count(*) AS count"""

CLEAN_CTE = f"""{WITH_DIRTY}, cleaned AS (
    SELECT region, federal_district, year, indicator, value, collected_at, seq FROM (
      SELECT *, row_number() OVER (PARTITION BY region, indicator, year
                                   ORDER BY collected_at, seq) AS copy
      FROM dirty WHERE region IS NOT NULL AND indicator IS NOT NULL
        AND value IS NOT NULL AND year IS NOT NULL)
    WHERE copy = 1 AND year BETWEEN 1990 AND 2030 AND isfinite(value))"""


def panel(spark: SparkSession, d: str) -> DataFrame:
    return adapters.obs(spark, d)


def orders(spark: SparkSession, d: str) -> DataFrame:
    return adapters.orders_panel(spark, d)


# --- filters and projections -------------------------------------------------


@register(
    "filter_prefix",
    f"{WITH_DIRTY} SELECT seq, indicator FROM dirty WHERE NOT starts_with(indicator, '_agg_')",
)
def filter_prefix(spark, d):
    rows = adapters.dirty(spark, d)
    return clean.without_service_rows(rows, SPEC).select("seq", "indicator")


FILTER = FilterSpec("2-HIGH", 1996, 1999, "NATION_3")


@register(
    "fetch_filtered",
    f"""{WITH_OBS} SELECT region, federal_district, year, indicator, value, collected_at FROM obs
    WHERE indicator = '2-HIGH' AND year >= 1996 AND year <= 1999 AND region = 'NATION_3'""",
)
def fetch_filtered(spark, d):
    return reports.fetch(panel(spark, d), FILTER, SPEC)


@register("fetch_pushed", ORACLES["fetch_filtered"])
def fetch_pushed(spark, d):
    """The same rows from files by indicator, by a source that takes the filter."""
    path = scratch(spark, "by-indicator")
    rows = panel(spark, d)
    sinks.write_by_indicator(rows, path)
    return reports.fetch(sources.fetch_from(spark, path, rows.schema, FILTER, SPEC), FilterSpec(), SPEC)


@register(
    "fetch_all",
    f"""{WITH_OBS} SELECT region, federal_district, year, indicator, value, collected_at
    FROM obs""",
)
def fetch_all(spark, d):
    return reports.fetch(panel(spark, d), FilterSpec(), SPEC)


@register(
    "fetch_metrics",
    f"""{WITH_OBS} SELECT count(*) AS rows, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS batches
    FROM obs WHERE indicator = '2-HIGH' AND year >= 1996""",
)
def fetch_metrics(spark, d):
    want = FilterSpec("2-HIGH", year_from=1996)
    return reports.fetch_metrics(reports.fetch(panel(spark, d), want, SPEC))


@register(
    "fetch_group_stats",
    f"""{WITH_OBS} SELECT federal_district, {avg2()} AS avg, min(value) AS min,
    max(value) AS max, count(*) AS count FROM obs
    WHERE indicator = '2-HIGH' AND year >= 1996 AND year <= 1999 GROUP BY 1""",
)
def fetch_group_stats(spark, d):
    want = FilterSpec("2-HIGH", 1996, 1999)
    return reports.fetch_group_stats(reports.fetch(panel(spark, d), want, SPEC), SPEC)


@register(
    "panel_filter",
    f"""{WITH_OBS} SELECT * FROM obs WHERE year BETWEEN 1997 AND 1999
    AND federal_district IN (SELECT r_name FROM region WHERE r_regionkey IN (0, 2))""",
)
def panel_filter(spark, d):
    region = adapters.table(spark, d, "region").where(F.col("r_regionkey").isin(0, 2))
    # the two districts a user picked in the filter list
    picked = region.select(F.col("r_name").alias("federal_district"))
    rows = panel(spark, d)
    return reports.panel_filter(rows, (1997, 1999), picked, SPEC).select(*rows.columns)


LABELS = {"1-URGENT": "Urgent", "2-HIGH": "High", "5-LOW": "Low"}


@register(
    "indicator_labels",
    f"""{WITH_ORDERS} SELECT DISTINCT indicator, CASE indicator WHEN '1-URGENT' THEN 'Urgent'
    WHEN '2-HIGH' THEN 'High' WHEN '5-LOW' THEN 'Low' ELSE indicator END AS label FROM obs""",
)
def indicator_labels(spark, d):
    codes = orders(spark, d).select("indicator").distinct()
    return reports.with_labels(codes, LABELS, SPEC)


# --- dedup and cleaning ------------------------------------------------------


@register(
    "dedup_first",
    f"""{WITH_OBS} SELECT region, federal_district, year, indicator, value, collected_at, seq
    FROM (SELECT *, row_number() OVER (PARTITION BY region, indicator, year
                                       ORDER BY collected_at, seq) AS copy FROM obs)
    WHERE copy = 1""",
)
def dedup_first(spark, d):
    return clean.keep_first(panel(spark, d), SPEC)


@register("dedup_batches", ORACLES["dedup_first"])
def dedup_batches(spark, d):
    """Keep-first over three batches, which follow each other in input order."""
    rows = panel(spark, d)
    at, kind = F.col("collected_at"), rows.schema["collected_at"].dataType
    low, high = (F.lit(x).cast(kind) for x in ("1994-06-01", "1996-06-01"))
    parts = [at < low, (at >= low) & (at < high), (at >= high) | at.isNull()]
    return increment.keep_first_batches([rows.where(p) for p in parts], SPEC)


@register("clean", f"{CLEAN_CTE} SELECT * FROM cleaned")
def clean_rows(spark, d):
    return clean.clean(adapters.dirty(spark, d), SPEC)


@register(
    "clean_report",
    f"""{WITH_DIRTY}, full_rows AS (
      SELECT *, row_number() OVER (PARTITION BY region, indicator, year
                                   ORDER BY collected_at, seq) AS copy
      FROM dirty WHERE region IS NOT NULL AND indicator IS NOT NULL
        AND value IS NOT NULL AND year IS NOT NULL),
    n AS (SELECT (SELECT count(*) FROM dirty) AS rows_before,
      (SELECT count(*) FROM full_rows WHERE copy = 1 AND year BETWEEN 1990 AND 2030
         AND isfinite(value)) AS rows_after,
      (SELECT count(*) FROM dirty) - (SELECT count(*) FROM full_rows) AS missing_required,
      (SELECT count(*) FROM full_rows WHERE copy > 1) AS later_copies,
      (SELECT count(*) FROM full_rows WHERE copy = 1 AND year NOT BETWEEN 1990 AND 2030)
         AS year_out_of_range,
      (SELECT count(*) FROM full_rows WHERE copy = 1 AND year BETWEEN 1990 AND 2030
         AND NOT isfinite(value)) AS not_finite)
    SELECT *, rows_before - rows_after AS rows_dropped FROM n""",
)
def clean_report(spark, d):
    return clean.clean_report(adapters.dirty(spark, d), SPEC)


@register("distinct_years", f"{WITH_ORDERS} SELECT DISTINCT year FROM obs")
def distinct_years(spark, d):
    return reports.sorted_distinct(orders(spark, d), "year")


@register("distinct_groups", f"{WITH_OBS} SELECT DISTINCT federal_district FROM obs")
def distinct_groups(spark, d):
    return reports.sorted_distinct(panel(spark, d), "federal_district")


# --- validation --------------------------------------------------------------

REGION_ERROR_SQL = """CASE WHEN region IS NULL THEN 'region: must be string'
    WHEN trim(region) = '' THEN 'region: must be non-empty'
    WHEN length(region) NOT BETWEEN 2 AND 8
    THEN 'region: length ' || length(region) || ' not in [2, 8]' END"""
YEAR_ERROR_SQL = """CASE WHEN year IS NULL THEN 'year: must be integer'
    WHEN year NOT BETWEEN 1996 AND 2000 THEN 'year: ' || year || ' not in [1996, 2000]' END"""
INDICATOR_ERROR_SQL = f"""CASE WHEN indicator IS NULL THEN 'indicator: must be string'
    WHEN indicator = '' THEN 'indicator: must be non-empty'
    WHEN indicator NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')
    THEN 'indicator: ''' || indicator || ''' not in {ALLOWED_SQL}' END"""
SHOWN_SQL = "regexp_replace(CAST(value AS VARCHAR), '[.]0$', '')"
RANGE_ERROR_SQL = f"""CASE
    WHEN indicator = '1-URGENT' AND value NOT BETWEEN 5000 AND 400000
    THEN 'value: ' || {SHOWN_SQL} || ' not in [5000.0, 400000.0] for 1-URGENT'
    WHEN indicator = '2-HIGH' AND value NOT BETWEEN 0 AND 450000
    THEN 'value: ' || {SHOWN_SQL} || ' not in [0.0, 450000.0] for 2-HIGH'
    WHEN indicator = '3-MEDIUM' AND value NOT BETWEEN 10000 AND 490000
    THEN 'value: ' || {SHOWN_SQL} || ' not in [10_000, 490_000] for 3-MEDIUM' END"""
VALUE_ERROR_SQL = f"""CASE WHEN value IS NULL THEN 'value: must be number'
    WHEN NOT isfinite(value) THEN 'value: must be finite number (not NaN/Inf)'
    ELSE {RANGE_ERROR_SQL} END"""
ERRORS_SQL = (
    f"concat_ws(' | ', {REGION_ERROR_SQL}, {YEAR_ERROR_SQL}, {INDICATOR_ERROR_SQL}, "
    f"{VALUE_ERROR_SQL})"
)
CHECKED_CTE = f"{WITH_DIRTY}, checked AS (SELECT *, {ERRORS_SQL} AS errors FROM dirty)"


def _field_query(field: str, sql: str) -> None:
    @register(
        f"validate_{field}",
        f"{WITH_DIRTY} SELECT seq, {sql} AS error FROM dirty WHERE ({sql}) IS NOT NULL",
    )
    def query(spark, d):
        rows = adapters.dirty(spark, d)
        check = validate.field_checks(rows, RULES, SPEC)[field]
        return rows.where(check.failed).select("seq", check.text.alias("error"))


_field_query("region", REGION_ERROR_SQL)
_field_query("year", YEAR_ERROR_SQL)
_field_query("indicator", INDICATOR_ERROR_SQL)
_field_query("value", VALUE_ERROR_SQL)


@register(
    "validate_range",
    f"""{WITH_ORDERS} SELECT seq, {RANGE_ERROR_SQL} AS error FROM obs
    WHERE ({RANGE_ERROR_SQL}) IS NOT NULL""",
)
def validate_range(spark, d):
    check = validate.value_check(F.col("value"), F.col("indicator"), RULES)
    return orders(spark, d).where(check.failed).select("seq", check.text.alias("error"))


@register(
    "validate_outcome",
    f"{CHECKED_CTE} SELECT seq, errors = '' AS valid, errors FROM checked",
)
def validate_outcome(spark, d):
    checked = validate.validate(adapters.dirty(spark, d), RULES, SPEC)
    return checked.select("seq", "valid", F.concat_ws(" | ", "errors").alias("errors"))


@register(
    "valid_rows",
    f"""{CHECKED_CTE} SELECT region, federal_district, year, indicator, value, collected_at, seq
    FROM checked WHERE errors = ''""",
)
def valid_rows(spark, d):
    return validate.valid_rows(adapters.dirty(spark, d), RULES, SPEC)


@register(
    "rejected_rows",
    f"""{CHECKED_CTE} SELECT seq, region, federal_district, year, indicator, errors
    FROM checked WHERE errors <> ''""",
)
def rejected_rows(spark, d):
    rejected = validate.rejected_rows(adapters.dirty(spark, d), RULES, SPEC)
    return rejected.select(
        "record.seq",
        "record.region",
        "record.federal_district",
        "record.year",
        "record.indicator",
        F.concat_ws(" | ", "errors").alias("errors"),
    )


@register(
    "error_categories",
    f"""{CHECKED_CTE}, one AS (SELECT unnest(string_split(errors, ' | ')) AS error FROM checked
      WHERE errors <> '')
    SELECT split_part(error, ':', 1) AS category, count(*) AS n FROM one GROUP BY 1
    ORDER BY n DESC, category LIMIT 5""",
)
def error_categories(spark, d):
    checked = validate.validate(adapters.dirty(spark, d), RULES, SPEC)
    return validate.error_categories(checked)


@register(
    "validate_shipments",
    f"""WITH s AS ({SHIPMENTS_SQL}), checked AS (SELECT year,
      CASE WHEN length(region) NOT BETWEEN 2 AND 8 THEN 1 ELSE 0 END
      + CASE WHEN year NOT BETWEEN 1996 AND 2000 THEN 1 ELSE 0 END
      + CASE WHEN indicator NOT IN ('A', 'N') THEN 1 ELSE 0 END
      + CASE WHEN indicator = 'A' AND value NOT BETWEEN 1000 AND 80000
             OR indicator = 'N' AND value NOT BETWEEN 0 AND 90000 THEN 1 ELSE 0 END AS errors
      FROM s)
    SELECT year, count(*) AS rows, CAST(count_if(errors = 0) AS BIGINT) AS valid_rows,
           CAST(sum(errors) AS BIGINT) AS errors FROM checked GROUP BY year""",
)
def validate_shipments(spark, d):
    rules = RuleSet(
        indicators=("A", "N"),
        ranges={"A": Range(1_000.0, 80_000.0), "N": Range(0.0, 90_000.0)},
        year_range=(1996, 2000),
        name_length=(2, 8),
    )
    checked = validate.validate(adapters.shipments(spark, d), rules, SPEC)
    return checked.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("valid").alias("valid_rows"),
        F.sum(F.size("errors")).alias("errors"),
    )


JSON_NUMBER = "('UBIGINT', 'BIGINT', 'DOUBLE', 'HUGEINT')"
JSON_ERRORS_SQL = f"""
    WITH lines AS ({JSON_SQL}), typed AS (
      SELECT seq, json_valid(line) AS ok,
        CASE WHEN json_valid(line) THEN json_type(line, '$.region') END AS rt,
        CASE WHEN json_valid(line) THEN json_type(line, '$.year') END AS yt,
        CASE WHEN json_valid(line) THEN json_type(line, '$.indicator') END AS it,
        CASE WHEN json_valid(line) THEN json_type(line, '$.value') END AS vt,
        CASE WHEN json_valid(line) THEN json_extract_string(line, '$.region') END AS region,
        CASE WHEN json_valid(line) THEN json_extract_string(line, '$.indicator') END AS ind,
        CASE WHEN json_valid(line) THEN json_extract_string(line, '$.year') END AS ys,
        CASE WHEN json_valid(line) THEN json_extract_string(line, '$.value') END AS vs
      FROM lines), fields AS (
      SELECT seq, ok, rt, yt, it, vt, region,
        CASE WHEN it = 'VARCHAR' THEN ind END AS indicator,
        CASE WHEN yt IN ('UBIGINT', 'BIGINT') THEN CAST(ys AS INTEGER) END AS year,
        CASE WHEN vt IN {JSON_NUMBER} THEN CAST(vs AS DOUBLE)
             WHEN vt = 'BOOLEAN' THEN CASE WHEN vs = 'true' THEN 1 ELSE 0 END END AS value
      FROM typed)
    SELECT seq, CASE WHEN NOT ok THEN 'record: malformed' ELSE concat_ws(' | ',
      CASE WHEN rt IS NULL THEN 'region: missing' WHEN rt <> 'VARCHAR'
           THEN 'region: must be string' ELSE {REGION_ERROR_SQL} END,
      CASE WHEN yt IS NULL THEN 'year: missing' WHEN yt NOT IN ('UBIGINT', 'BIGINT')
           THEN 'year: must be integer' ELSE {YEAR_ERROR_SQL} END,
      CASE WHEN it IS NULL THEN 'indicator: missing' WHEN it <> 'VARCHAR'
           THEN 'indicator: must be string' ELSE {INDICATOR_ERROR_SQL} END,
      CASE WHEN vt IS NULL THEN 'value: missing' WHEN value IS NULL
           THEN 'value: must be number' ELSE {VALUE_ERROR_SQL} END) END AS errors
    FROM fields"""


@register("validate_variant", JSON_ERRORS_SQL)
def validate_variant(spark, d):
    checked = validate_json(adapters.json_lines(spark, d), RULES)
    return checked.select("seq", F.concat_ws(" | ", "errors").alias("errors"))


# --- aggregates --------------------------------------------------------------


@register(
    "agg_group_indicator",
    f"""{WITH_OBS} SELECT federal_district, indicator, {GROUP_STATS_SQL} FROM obs
    GROUP BY 1, 2""",
)
def agg_group_indicator(spark, d):
    return aggregate.group_stats(panel(spark, d), ["federal_district", "indicator"], SPEC)


@register(
    "agg_shipments",
    f"""SELECT federal_district, indicator, {GROUP_STATS_SQL} FROM ({SHIPMENTS_SQL})
    GROUP BY 1, 2""",
)
def agg_shipments(spark, d):
    return aggregate.group_stats(
        adapters.shipments(spark, d), ["federal_district", "indicator"], SPEC
    )


@register(
    "agg_median",
    f"{WITH_OBS} SELECT region, indicator, {STATS_SQL} FROM obs GROUP BY 1, 2",
)
def agg_median(spark, d):
    return aggregate.median_stats(panel(spark, d), ["region", "indicator"], SPEC)


@register(
    "median_shipments",
    f"SELECT region, indicator, {STATS_SQL} FROM ({SHIPMENTS_SQL}) GROUP BY 1, 2",
)
def median_shipments(spark, d):
    return aggregate.median_stats(adapters.shipments(spark, d), ["region", "indicator"], SPEC)


@register(
    "median_hot",
    f"""SELECT indicator, {STATS_SQL} FROM (
      SELECT 'all' AS indicator, value FROM ({SHIPMENTS_SQL})
      UNION ALL SELECT 'one supplier' AS indicator, value FROM ({SHIPMENTS_SQL})
        WHERE region = 'NATION_3') GROUP BY 1""",
)
def median_hot(spark, d):
    """Groups of half a million values and more, with the split path forced at any size."""
    rows = adapters.shipments(spark, d)
    one = rows.where(F.col("region") == "NATION_3").withColumn("indicator", F.lit("one supplier"))
    both = rows.withColumn("indicator", F.lit("all")).unionByName(one)
    return aggregate.median_stats(both, ["indicator"], SPEC, heavy_rows=1000)


@register(
    "stats_dirty",
    f"""{WITH_DIRTY}, shown AS (SELECT federal_district, seq % 50 AS part,
        CASE WHEN seq % 4 = 0 THEN CASE WHEN isnan(value) THEN NULL ELSE value END
             WHEN seq % 4 = 1 THEN value
             ELSE CASE WHEN isfinite(value) THEN value END END AS value FROM dirty),
    kinds AS (SELECT federal_district, part, count(value) AS n,
        count_if(isnan(value)) > 0 AS nan, count_if(isinf(value)) > 0 AS inf,
        CAST(sum(CASE WHEN isfinite(value) THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE) AS s,
        min(value) AS min, max(value) AS max, count(*) AS count FROM shown GROUP BY 1, 2),
    sums AS (SELECT *, CASE WHEN n = 0 THEN NULL WHEN nan THEN CAST('nan' AS DOUBLE)
        WHEN inf THEN CAST('infinity' AS DOUBLE) ELSE s END AS sum FROM kinds)
    SELECT federal_district, part, sum, CASE WHEN n > 0 THEN {r("sum / CAST(n AS DOUBLE)")} END AS avg,
        min, max, count FROM sums""",
)
def stats_dirty(spark, d):
    """Sums over nulls, NaN and infinities, which must show in the result."""
    rows = adapters.dirty(spark, d)
    value, kind = F.col("value"), F.col("seq") % 4
    shown = (
        F.when(kind == 0, F.when(~F.isnan(value), value))
        .when(kind == 1, value)
        .otherwise(F.when(is_finite(value), value))
    )
    some = rows.select("federal_district", (F.col("seq") % 50).alias("part"), shown.alias("value"))
    return aggregate.group_stats(some, ["federal_district", "part"], SPEC)


@register(
    "avg_since",
    f"""{WITH_OBS} SELECT federal_district, indicator, {r(avg2())} AS avg_val, count(*) AS n
    FROM obs WHERE year >= 1999 GROUP BY 1, 2 ORDER BY 1, 2 LIMIT 20""",
)
def avg_since(spark, d):
    return aggregate.average_since(panel(spark, d), 1999, 20, SPEC)


@register(
    "dynamics",
    f"""{WITH_OBS} SELECT federal_district, year, {avg2()} AS avg FROM obs
    WHERE indicator = '1-URGENT' GROUP BY 1, 2""",
)
def dynamics(spark, d):
    return aggregate.dynamics(panel(spark, d), "1-URGENT", SPEC)


@register(
    "top5_mean",
    f"""{WITH_OBS} SELECT region, {avg2()} AS avg_value, count(*) AS n FROM obs
    WHERE indicator = '2-HIGH' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def top5_mean(spark, d):
    return aggregate.top_means(panel(spark, d), "2-HIGH", 5, SPEC)


LATEST_SQL = """FROM obs WHERE indicator = '{0}'
    AND year = (SELECT max(year) FROM obs WHERE indicator = '{0}')"""


@register(
    "kpi_total",
    f"""{WITH_ORDERS} SELECT max(year) AS year, {sum2()} AS total,
    {sum2()} / CAST(1000000 AS DOUBLE) AS total_in_units {LATEST_SQL.format("1-URGENT")}""",
)
def kpi_total(spark, d):
    return aggregate.kpi_total(orders(spark, d), "1-URGENT", spec=SPEC)


@register(
    "kpi_mean",
    f"""{WITH_ORDERS} SELECT max(year) AS year, {avg2()} AS avg {LATEST_SQL.format("2-HIGH")}""",
)
def kpi_mean(spark, d):
    return aggregate.kpi_mean(orders(spark, d), "2-HIGH", SPEC)


@register(
    "kpi_negative",
    f"""{WITH_ORDERS} SELECT max(year) AS year, CAST(count_if(value - 250000 < 0) AS BIGINT) AS n
    {LATEST_SQL.format("3-MEDIUM")}""",
)
def kpi_negative(spark, d):
    shifted = orders(spark, d).withColumn("value", F.col("value") - 250_000)
    return aggregate.kpi_negative(shifted, "3-MEDIUM", SPEC)


@register(
    "kpi_empty",
    f"""{WITH_ORDERS}, rows AS (SELECT * FROM obs WHERE indicator = 'none')
    SELECT kpi, CASE WHEN (SELECT count(*) FROM rows) = 0 THEN '—' ELSE 'x' END AS label
    FROM (VALUES ('total'), ('mean'), ('negative')) AS v(kpi)""",
)
def kpi_empty(spark, d):
    rows = orders(spark, d)
    labels = {
        "total": reports.total_label(aggregate.kpi_total(rows, "none", spec=SPEC)),
        "mean": reports.mean_label(aggregate.kpi_mean(rows, "none", SPEC)),
        "negative": reports.count_label(aggregate.kpi_negative(rows, "none", SPEC)),
    }
    total, mean, negative = (df.withColumn("kpi", F.lit(kpi)) for kpi, df in labels.items())
    return total.unionByName(mean).unionByName(negative)


@register(
    "histogram40",
    f"""{WITH_ORDERS}, v AS (SELECT value AS v FROM obs WHERE indicator = '2-HIGH'),
    x AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                 CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM v),
    e AS (SELECT i, CASE WHEN i = 40 THEN hi
                    ELSE lo + i * ((hi - lo) / CAST(40 AS DOUBLE)) END AS edge
          FROM x, range(0, 41) AS t(i)),
    b AS (SELECT a.i AS i, a.edge AS low, z.edge AS high FROM e a JOIN e z ON z.i = a.i + 1)
    SELECT CAST(i + 1 AS INTEGER) AS bin, low, high, count(v) AS n
    FROM b LEFT JOIN v ON v >= low AND (v < high OR (i = 39 AND v <= high)) GROUP BY 1, 2, 3""",
)
def histogram40(spark, d):
    return aggregate.histogram(orders(spark, d), "2-HIGH", 40, SPEC)


@register(
    "panel_extent",
    f"""{WITH_ORDERS} SELECT count(*) AS rows, min(year) AS first_year, max(year) AS last_year
    FROM obs""",
)
def panel_extent(spark, d):
    return aggregate.extent(orders(spark, d), SPEC)


# --- sort, top-k, scores -----------------------------------------------------

SLICE_SQL = "FROM obs WHERE indicator = '1-URGENT' AND year = 2000"
TIES_SQL = "ORDER BY value DESC, region, collected_at, seq"


@register("first_n", f"{WITH_OBS} SELECT * FROM obs ORDER BY collected_at, seq LIMIT 10000")
def first_n(spark, d):
    return reports.first_rows(panel(spark, d), 10_000, SPEC)


@register(
    "top10_slice",
    f"""{WITH_OBS} SELECT region, {r("value", 1)} AS value FROM (
    SELECT * {SLICE_SQL} {TIES_SQL} LIMIT 10)""",
)
def top10_slice(spark, d):
    return reports.top_slice(panel(spark, d), "1-URGENT", 2000, 10, SPEC)


@register("year_slice", f"{WITH_OBS} SELECT * {SLICE_SQL}")
def year_slice(spark, d):
    return reports.year_slice(panel(spark, d), "1-URGENT", 2000, SPEC)


@register(
    "top20_scored",
    f"""{WITH_OBS}, top AS (SELECT * {SLICE_SQL} {TIES_SQL} LIMIT 20)
    SELECT region, federal_district, value,
      CASE WHEN max(value) OVER () = min(value) OVER () THEN CAST(0.5 AS DOUBLE)
           ELSE (value - min(value) OVER ()) / (max(value) OVER () - min(value) OVER ()) END
      AS score FROM top""",
)
def top20_scored(spark, d):
    return reports.top_scored(panel(spark, d), "1-URGENT", 2000, 20, SPEC)


@register(
    "top20_stats",
    f"""{WITH_OBS}, top AS (SELECT value {SLICE_SQL} {TIES_SQL} LIMIT 20)
    SELECT {median()} AS median, min(value) AS min, max(value) AS max FROM top""",
)
def top20_stats(spark, d):
    return reports.top_stats(panel(spark, d), "1-URGENT", 2000, 20, SPEC)


# --- shape of the panel ------------------------------------------------------

MEMBERS = ["node-c", "node-a", "node-b"]


@register(
    "shard_assign",
    """WITH n AS (SELECT n_name AS name, n_nationkey AS place,
        row_number() OVER (ORDER BY n_nationkey) - 1 AS position FROM nation)
    SELECT name, place, position,
           ['node-a', 'node-b', 'node-c'][CAST(position % 3 AS INTEGER) + 1] AS member FROM n""",
)
def shard_assign(spark, d):
    nation = adapters.table(spark, d, "nation")
    dimension = nation.select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("place"))
    return shape.assign_shards(dimension, MEMBERS, ["place"])


@register(
    "partition_by_key",
    f"""{WITH_OBS} SELECT region, count(*) AS rows, CAST(1 AS BIGINT) AS partitions
    FROM obs GROUP BY 1""",
)
def partition_by_key(spark, d):
    """Each entity lies in one partition; the order inside is tested apart."""
    placed = shape.partition_by_key(panel(spark, d), 3, SPEC)
    return (
        placed.withColumn("part", F.spark_partition_id())
        .groupBy("region")
        .agg(
            F.count(F.lit(1)).alias("rows"), F.count_distinct("part").alias("partitions")
        )
    )


GRID_YEARS = (1995, 2002)
GRID_CODES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
GRID_SQL = f"""WITH part AS ({CUSTOMERS_SQL}),
    grid AS (SELECT region, CAST(y AS INTEGER) AS year, indicator
      FROM (SELECT DISTINCT region FROM part), range(1995, 2003) AS t(y),
      (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW'))
        AS i(indicator)),
    cells AS (SELECT DISTINCT region, year, indicator FROM part)"""


@register(
    "panel_coverage",
    f"""{GRID_SQL} SELECT region, 40 AS expected, CAST(count(*) AS INTEGER) AS present,
    CAST(40 - count(*) AS INTEGER) AS missing FROM cells GROUP BY region""",
)
def panel_coverage(spark, d):
    return shape.coverage(adapters.customers(spark, d), GRID_YEARS, GRID_CODES, SPEC)


@register(
    "panel_gaps",
    f"""{GRID_SQL} SELECT region, year, indicator FROM grid
    EXCEPT SELECT region, year, indicator FROM cells""",
)
def panel_gaps(spark, d):
    return shape.gaps(adapters.customers(spark, d), GRID_YEARS, GRID_CODES, SPEC)


# suppliers stand for entities of a dimension that never occur in the panel
ALL_ENTITIES_SQL = f"""{GRID_SQL.replace("FROM (SELECT DISTINCT region FROM part)",
    "FROM everyone")}""".replace("grid AS", """everyone AS (SELECT DISTINCT region FROM part
    UNION SELECT s_name FROM supplier), grid AS""", 1)


def _everyone(spark: SparkSession, d: str) -> DataFrame:
    return adapters.table(spark, d, "supplier").select(F.col("s_name").alias("region"))


@register(
    "coverage_dimension",
    f"""{ALL_ENTITIES_SQL} SELECT region, 40 AS expected, CAST(count(year) AS INTEGER) AS present,
    CAST(40 - count(year) AS INTEGER) AS missing
    FROM everyone LEFT JOIN cells USING (region) GROUP BY region""",
)
def coverage_dimension(spark, d):
    rows, everyone = adapters.customers(spark, d), _everyone(spark, d)
    return shape.coverage(rows, GRID_YEARS, GRID_CODES, SPEC, everyone)


@register(
    "gaps_dimension",
    f"""{ALL_ENTITIES_SQL} SELECT region, year, indicator FROM grid
    EXCEPT SELECT region, year, indicator FROM cells""",
)
def gaps_dimension(spark, d):
    rows, everyone = adapters.customers(spark, d), _everyone(spark, d)
    return shape.gaps(rows, GRID_YEARS, GRID_CODES, SPEC, everyone)


BASELINE = Baseline(
    params={
        "1-URGENT": (250_000.0, 140_000.0),
        "2-HIGH": (240_000.0, 120_000.0),
        "3-MEDIUM": (260_000.0, 150_000.0),
    },
    entity_means={"1-URGENT": {"NATION_0": 300_000.0, "NATION_7": 200_000.0}},
    growth=(Growth("1-URGENT", 1995, 0.003),),
    steps=(Step("2-HIGH", 1997, 1998, 1_500.0), Step("2-HIGH", 1999, None, -500.0)),
    slopes=(Slope("3-MEDIUM", 1997, -80.0, first=1997),),
)


@register(
    "baseline_residual",
    f"""{WITH_OBS}, m AS (SELECT seq, value,
      CASE indicator
        WHEN '1-URGENT' THEN CAST(CASE region WHEN 'NATION_0' THEN 300000
            WHEN 'NATION_7' THEN 200000 ELSE 250000 END AS DOUBLE)
            * (CAST(1 AS DOUBLE) + (year - 1995) * CAST(0.003 AS DOUBLE))
        WHEN '2-HIGH' THEN CAST(240000 + CASE WHEN year BETWEEN 1997 AND 1998 THEN 1500
            WHEN year >= 1999 THEN -500 ELSE 0 END AS DOUBLE)
        WHEN '3-MEDIUM' THEN CAST(260000 + CASE WHEN year >= 1997 THEN (year - 1997) * -80
            ELSE 0 END AS DOUBLE) END AS mu,
      CAST(CASE indicator WHEN '1-URGENT' THEN 140000 WHEN '2-HIGH' THEN 120000
           WHEN '3-MEDIUM' THEN 150000 END AS DOUBLE) AS sigma FROM obs)
    SELECT seq, mu, sigma, (value - mu) / sigma AS z FROM m""",
)
def baseline_residual(spark, d):
    return shape.residuals(panel(spark, d), BASELINE, SPEC).select("seq", "mu", "sigma", "z")


BOUNDS = {"1-URGENT": (10_000.0, 400_000.0), "3-MEDIUM": (50_000.0, None)}


@register(
    "clamp_round",
    f"""{WITH_ORDERS}, c AS (SELECT seq, CASE indicator
      WHEN '1-URGENT' THEN greatest(CAST(10000 AS DOUBLE), least(value, CAST(400000 AS DOUBLE)))
      WHEN '3-MEDIUM' THEN greatest(CAST(50000 AS DOUBLE), value) ELSE value END AS value
      FROM obs)
    SELECT seq, {r("value", 1)} AS value FROM c""",
)
def clamp_round(spark, d):
    return shape.clamp_round(orders(spark, d), BOUNDS, 1, SPEC).select("seq", "value")


# --- windows -----------------------------------------------------------------


def events(spark: SparkSession, d: str) -> DataFrame:
    return adapters.ev(spark, d)


@register(
    "window_tumbling",
    f"""{WITH_EV} SELECT time_bucket(INTERVAL '10 seconds', collected_at) AS window_start,
    time_bucket(INTERVAL '10 seconds', collected_at) + INTERVAL '10 seconds' AS window_end,
    region, indicator, {STATS_SQL} FROM ev GROUP BY 1, 2, 3, 4""",
)
def window_tumbling(spark, d):
    return windows.tumbling(events(spark, d), "10 seconds", SPEC)


def _with_shard(rows: DataFrame) -> DataFrame:
    """Users folded into four teams; each team is one shard."""
    team = F.col("region").cast("bigint") % 4
    return rows.withColumns({"region": team.cast("string"), "shard": team.cast("int")})


SHARDED_CTE = f"""{WITH_EV}, s AS (SELECT CAST(CAST(region AS BIGINT) % 4 AS VARCHAR) AS region,
      CAST(CAST(region AS BIGINT) % 4 AS INTEGER) AS shard, indicator, value, collected_at, seq,
      time_bucket(INTERVAL '6 hours', collected_at) AS tick FROM ev)"""


@register(
    "window_tumbling_day",
    f"""{SHARDED_CTE} SELECT time_bucket(INTERVAL '1 day', collected_at) AS window_start,
    time_bucket(INTERVAL '1 day', collected_at) + INTERVAL '1 day' AS window_end,
    region, indicator, {STATS_SQL} FROM s GROUP BY 1, 2, 3, 4""",
)
def window_tumbling_day(spark, d):
    return windows.tumbling(_with_shard(events(spark, d)), "1 day", SPEC)


@register(
    "window_count",
    f"""{SHARDED_CTE},
    c AS (SELECT *, (row_number() OVER (PARTITION BY shard ORDER BY collected_at, seq) - 1) // 50
          AS chunk FROM s),
    b AS (SELECT *, min(collected_at) OVER w AS window_start, max(collected_at) OVER w
          AS window_end FROM c WINDOW w AS (PARTITION BY shard, chunk))
    SELECT shard, chunk, window_start, window_end, region, indicator, {STATS_SQL}
    FROM b GROUP BY 1, 2, 3, 4, 5, 6""",
)
def window_count(spark, d):
    return windows.count_windows(_with_shard(events(spark, d)), 50, ["shard"], SPEC)


@register(
    "window_count_global",
    f"""{SHARDED_CTE},
    c AS (SELECT *, (row_number() OVER (ORDER BY collected_at, seq) - 1) // 50 AS chunk FROM s),
    b AS (SELECT *, min(collected_at) OVER w AS window_start, max(collected_at) OVER w
          AS window_end FROM c WINDOW w AS (PARTITION BY chunk))
    SELECT chunk, window_start, window_end, region, indicator, {STATS_SQL}
    FROM b GROUP BY 1, 2, 3, 4, 5""",
)
def window_count_global(spark, d):
    """One counter over all events, with the split path forced at any size."""
    rows = _with_shard(events(spark, d)).drop("shard")
    return windows.count_windows(rows, 50, (), SPEC, heavy_rows=500)


HYBRID_SQL = f"""{SHARDED_CTE},
    c AS (SELECT *, (row_number() OVER (PARTITION BY shard, tick ORDER BY collected_at, seq) - 1)
          // 12 AS chunk FROM s),
    b AS (SELECT *, min(collected_at) OVER w AS window_start, max(collected_at) OVER w
          AS window_end FROM c WINDOW w AS (PARTITION BY shard, tick, chunk))
    SELECT shard, tick, chunk, window_start, window_end, region, indicator, {STATS_SQL}
    FROM b GROUP BY 1, 2, 3, 4, 5, 6, 7"""


@register("window_hybrid", HYBRID_SQL)
def window_hybrid(spark, d):
    return windows.hybrid_windows(_with_shard(events(spark, d)), "6 hours", 12, ["shard"], SPEC)


SLIDING_CTE = f"""{WITH_EV}, w AS (
      SELECT time_bucket(INTERVAL '30 seconds', collected_at) - to_seconds(30 * i) AS window_start,
             region, value FROM ev, range(0, 10) AS t(i) WHERE indicator = 'click'),
    means AS (SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, region,
      {avg2()} AS avg_value, count(*) AS n FROM w GROUP BY 1, 2, 3)"""


@register("window_sliding", f"{SLIDING_CTE} SELECT * FROM means")
def window_sliding(spark, d):
    return windows.sliding_means(events(spark, d), "click", spec=SPEC)


TOP5_SQL = """SELECT * FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY window_start, window_end ORDER BY avg_value DESC, region) AS INTEGER) AS rank
    FROM {0}) WHERE rank <= 5"""


@register("window_top5", f"{SLIDING_CTE} {TOP5_SQL.format('means')}")
def window_top5(spark, d):
    means = windows.sliding_means(events(spark, d), "click", spec=SPEC)
    return windows.top_per_window(means, 5, SPEC)


def _now(rows: DataFrame):
    """Latest event time as a scalar subquery."""
    return rows.agg(F.max("collected_at")).scalar()


@register(
    "window_trailing",
    f"""{WITH_EV} SELECT * FROM ev
    WHERE collected_at >= (SELECT max(collected_at) FROM ev) - INTERVAL '3 days'""",
)
def window_trailing(spark, d):
    rows = events(spark, d)
    return windows.trailing(rows, _now(rows), "3 days", SPEC)


@register(
    "evicted_count",
    f"""{WITH_EV}, n AS (SELECT max(collected_at) - INTERVAL '3 days' AS cut FROM ev)
    SELECT CAST(count_if(collected_at < cut) AS BIGINT) AS evicted,
      CAST(count_if(collected_at >= cut) AS BIGINT) AS kept
    FROM ev, n""",
)
def evicted_count(spark, d):
    rows = events(spark, d)
    return windows.evicted_count(rows, _now(rows), "3 days", SPEC)


# --- sources and sinks -------------------------------------------------------

RECORD_COLUMNS = ["region", "federal_district", "year", "indicator", "value", "collected_at"]


def _naive(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _zoned_records(df: DataFrame) -> DataFrame:
    return df.select(
        "region",
        "federal_district",
        F.col("year").cast("bigint").alias("year"),
        "indicator",
        "value",
        F.col("collected_at").cast("timestamp").alias("collected_at"),
    )


@register(
    "scan_ndjson",
    f"""{WITH_DIRTY} SELECT region, federal_district, CAST(year AS BIGINT) AS year, indicator,
    CASE WHEN isfinite(value) THEN value END AS value, collected_at
    FROM dirty WHERE NOT starts_with(indicator, '_agg_')""",
)
def scan_ndjson(spark, d):
    path = scratch(spark, "scan") + ".ndjson"
    # JSON has no NaN or infinity: such values are written as absent
    value = F.when(is_finite(F.col("value")), F.col("value"))
    sinks.append_ndjson(_zoned_records(adapters.dirty(spark, d).withColumn("value", value)), path)
    return _naive(sources.load_raw(spark, path), "collected_at")


@register(
    "scan_lenient",
    f"""WITH lines AS ({JSON_SQL}), ok AS (SELECT line FROM lines WHERE json_valid(line)),
    t AS (SELECT line, json_type(line, '$.region') AS rt, json_type(line, '$.year') AS yt,
            json_type(line, '$.indicator') AS it, json_type(line, '$.value') AS vt FROM ok)
    SELECT coalesce(json_extract_string(line, '$.region'), '') AS region, '' AS federal_district,
      coalesce(CAST(json_extract_string(line, '$.year') AS BIGINT), 0) AS year,
      coalesce(json_extract_string(line, '$.indicator'), '') AS indicator,
      coalesce(CAST(json_extract_string(line, '$.value') AS DOUBLE), 0) AS value
    FROM t WHERE coalesce(rt, 'NULL') IN ('VARCHAR', 'NULL')
      AND coalesce(yt, 'NULL') IN ('UBIGINT', 'BIGINT', 'NULL')
      AND coalesce(it, 'NULL') IN ('VARCHAR', 'NULL')
      AND coalesce(vt, 'NULL') IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')""",
)
def scan_lenient(spark, d):
    path = scratch(spark, "lenient")
    adapters.json_lines(spark, d).select("value").write.text(path)
    return sources.scan_lenient(spark, path).drop("collected_at")


@register(
    "dim_regions",
    """SELECT n_name AS name, r_name AS federal_district
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def dim_regions(spark, d):
    path = scratch(spark, "dimension")
    nation = adapters.table(spark, d, "nation")
    region = adapters.table(spark, d, "region")
    rows = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("name"), F.col("r_name").alias("federal_district")
    )
    # one array per district; the nation table has a fixed number of rows
    arrays = rows.groupBy("federal_district").agg(
        F.to_json(F.collect_list(F.struct("name", "federal_district"))).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return sources.read_dimension(spark, path, DIMENSION_SCHEMA)


@register(
    "latest_dataset",
    f"{WITH_OBS} SELECT 'panel.parquet' AS dataset, count(*) AS rows FROM obs",
)
def latest_dataset(spark, d):
    root = scratch(spark, "datasets")
    rows = panel(spark, d)
    sinks.append_ndjson(rows.where("year = 1999"), f"{root}/old/raw.ndjson")
    sinks.write_parquet(rows, f"{root}/panel.parquet")
    sinks.write_parquet(rows.where("year = 2000"), f"{root}/rejected.parquet")
    found = sources.latest_dataset(spark, root)
    counted = sources.load_latest(spark, root).agg(F.count(F.lit(1)).alias("rows"))
    return found.select("dataset", counted.scalar().alias("rows"))


RECORDS_SQL = f"""{WITH_OBS} SELECT region, federal_district, CAST(year AS BIGINT) AS year,
    indicator, value, collected_at FROM obs"""


@register("sink_ndjson_roundtrip", RECORDS_SQL)
def sink_ndjson_roundtrip(spark, d):
    path = scratch(spark, "sink") + ".ndjson"
    rows = _zoned_records(panel(spark, d))
    sinks.append_ndjson(rows.where("year < 1998"), path)
    sinks.append_ndjson(rows.where("year >= 1998"), path)
    return _naive(spark.read.schema(RECORD_SCHEMA).json(path), "collected_at")


@register("sink_parquet_roundtrip", f"{WITH_OBS} SELECT * FROM obs")
def sink_parquet_roundtrip(spark, d):
    path = scratch(spark, "sink") + ".parquet"
    sinks.write_parquet(panel(spark, d), path)
    return spark.read.parquet(path)


@register("sink_by_indicator", f"{WITH_OBS} SELECT * FROM obs WHERE indicator = '2-HIGH'")
def sink_by_indicator(spark, d):
    path = scratch(spark, "sink") + ".parquet"
    sinks.write_by_indicator(panel(spark, d), path)
    return spark.read.parquet(path).where(F.col("indicator") == "2-HIGH")


@register(
    "to_messages",
    f"""{WITH_OBS} SELECT region AS key, '{{"region":"' || region || '","federal_district":"'
    || federal_district || '","year":' || year || ',"indicator":"' || indicator
    || '","value":' || CAST(value AS VARCHAR) || ',"collected_at":"'
    || strftime(collected_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}' AS value FROM obs""",
)
def to_messages(spark, d):
    return sinks.to_messages(panel(spark, d), SPEC)


# --- streams -----------------------------------------------------------------


def _finish(query) -> None:
    query.awaitTermination()


def _folders(spark: SparkSession, name: str) -> tuple[str, str]:
    return scratch(spark, name), scratch(spark, f"{name}-checkpoint")


EVENT_SCHEMA = (
    T.StructType()
    .add("region", T.StringType())
    .add("indicator", T.StringType())
    .add("value", T.DoubleType())
    .add("collected_at", T.StringType())
    .add("seq", T.LongType())
)
EVENT_TIME_SQL = "strftime(collected_at, '%Y-%m-%dT%H:%M:%S.%fZ')"


def _message_stream(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON texts in files, every 97th one cut short, read as a stream."""
    path = scratch(spark, "messages")
    spec_columns = ["region", "indicator", "value", "collected_at", "seq"]
    texts = sinks.to_messages(events(spark, d), SPEC, spec_columns)
    seq = F.get_json_object("value", "$.seq").cast("bigint")
    cut = F.when(seq % 97 == 0, F.substring("value", 1, 25)).otherwise(F.col("value"))
    texts.select(cut.alias("value")).write.text(path)
    return sources.text_stream(spark, path).select("value")


@register(
    "stream_ingest",
    f"""{WITH_EV} SELECT region, indicator, value, {EVENT_TIME_SQL} AS collected_at, seq FROM ev
    WHERE seq % 97 <> 0""",
)
def stream_ingest(spark, d):
    path, checkpoint = _folders(spark, "ingest")
    parsed = sources.parse_messages(_message_stream(spark, d), EVENT_SCHEMA)
    _finish(streaming.to_parquet(parsed, path, checkpoint))
    return spark.read.parquet(path)


@register(
    "ingest_metrics",
    f"""{WITH_EV} SELECT count(*) AS messages,
    CAST(count_if(seq % 97 <> 0) AS BIGINT) AS records,
    CAST(count_if(seq % 97 = 0) AS BIGINT) AS errors FROM ev""",
)
def ingest_metrics(spark, d):
    """What the listener noted while the messages were read; the output is not counted."""
    path, checkpoint = _folders(spark, "metrics")
    parsed = sources.parse_messages(_message_stream(spark, d), EVENT_SCHEMA, keep_bad=True)
    monitor = streaming.FlowMonitor(spark, scratch(spark, "metrics-table"))
    spark.streams.addListener(monitor)
    try:
        query = streaming.to_parquet(streaming.observed(parsed), path, checkpoint)
        _finish(query)
        monitor.await_end(query)
    finally:
        spark.streams.removeListener(monitor)
    return monitor.totals().drop("write_errors")


@register(
    "stream_log",
    f"""{WITH_EV} SELECT region, indicator, value, {EVENT_TIME_SQL} AS collected_at, seq,
    row_number() OVER (PARTITION BY region ORDER BY ev.collected_at, seq) AS place FROM ev""",
)
def stream_log(spark, d):
    """Events through the keyed log in two writes, by a limited reader that stops in between."""
    path, checkpoint = _folders(spark, "log")
    log = scratch(spark, "keyed-log")
    columns = ["region", "indicator", "value", "collected_at", "seq"]
    rows = events(spark, d)
    half = F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (F.col("collected_at") < half, F.col("collected_at") >= half):
        named = sinks.message_columns(rows, SPEC, columns)
        messages = rows.where(part).select(
            *[c.alias(n) for n, c in named.items()], F.col("collected_at").alias("at"), "seq"
        )
        sources.write_log(messages, log, ["at", "seq"])
        stream = sources.log_stream(spark, log, limit=20_000, reader="query")
        query = streaming.to_parquet(stream, path, checkpoint, every="0 seconds")
        query.processAllAvailable()
        query.stop()
    stored = sources.parse_messages(spark.read.parquet(path), EVENT_SCHEMA)
    place = F.row_number().over(Window.partitionBy("key").orderBy("partition", "offset"))
    return stored.withColumn("place", place.cast("bigint")).select(*columns, "place")


def _closed(df: DataFrame) -> DataFrame:
    """Closed windows with their bounds as UTC wall time."""
    return df.withColumns({c: utc_naive(F.col(c)) for c in streaming.WINDOW})


@register(
    "stream_tumbling",
    f"""{WITH_EV}, w AS (
      SELECT time_bucket(INTERVAL '10 seconds', collected_at) AS window_start,
      time_bucket(INTERVAL '10 seconds', collected_at) + INTERVAL '10 seconds' AS window_end,
      region, indicator, {STATS_SQL} FROM ev GROUP BY 1, 2, 3, 4)
    SELECT * FROM w""",
)
def stream_tumbling(spark, d):
    path, checkpoint = _folders(spark, "tumbling")
    rows = adapters.ev_stream(spark, d, closing=F.lit(True))
    _finish(streaming.tumbling_stream(rows, path, checkpoint, spec=SPEC))
    return _closed(spark.read.parquet(path).drop("batch_id"))


@register(
    "stream_tumbling_day",
    f"""{SHARDED_CTE}, w AS (
      SELECT time_bucket(INTERVAL '1 day', collected_at) AS window_start,
      time_bucket(INTERVAL '1 day', collected_at) + INTERVAL '1 day' AS window_end,
      region, indicator, {STATS_SQL} FROM s GROUP BY 1, 2, 3, 4)
    SELECT * FROM w""",
)
def stream_tumbling_day(spark, d):
    path, checkpoint = _folders(spark, "tumbling-day")
    rows = _with_shard(adapters.ev_stream(spark, d, closing=F.lit(True)))
    _finish(streaming.tumbling_stream(rows, path, checkpoint, "1 day", spec=SPEC))
    return _closed(spark.read.parquet(path).drop("batch_id"))


def _sliding(spark: SparkSession, d: str) -> DataFrame:
    rows = adapters.ev_stream(spark, d, closing=F.col("event_type") == "click")
    return streaming.sliding_stream(rows, "click", spec=SPEC)


@register(
    "stream_sliding",
    f"{SLIDING_CTE} SELECT * FROM means",
)
def stream_sliding(spark, d):
    path, checkpoint = _folders(spark, "sliding")
    _finish(streaming.to_parquet(_sliding(spark, d), path, checkpoint))
    return _closed(spark.read.parquet(path))


@register(
    "stream_top5",
    f"{SLIDING_CTE} {TOP5_SQL.format('means')}",
)
def stream_top5(spark, d):
    path, checkpoint = _folders(spark, "top5")
    _finish(streaming.top_stream(_sliding(spark, d), path, checkpoint, 5, spec=SPEC))
    stored = spark.read.parquet(path).drop("batch_id")
    return _closed(stored)


@register("stream_flush", f"{WITH_EV} SELECT * FROM ev")
def stream_flush(spark, d):
    path, checkpoint = _folders(spark, "flush")
    _finish(streaming.flush_stream(adapters.ev_stream(spark, d), path, checkpoint))
    return spark.read.parquet(path).drop("batch_id")


@register("stream_tee", HYBRID_SQL)
def stream_tee(spark, d):
    """Raw rows by tick and NDJSON windows next to them, committed together."""
    raw, checkpoint = _folders(spark, "tee")
    rows = _with_shard(adapters.ev_stream(spark, d))
    how = {"duration": "6 hours", "size": 12, "shard": ["shard"], "spec": SPEC}
    _finish(streaming.tee_stream(rows, f"{raw}/raw", None, checkpoint, **how))
    streaming.finish_tee(spark, f"{raw}/raw", None, **how)
    tee = streaming.Tee(f"{raw}/raw", sinks.aggregated_path(f"{raw}/raw"), **how)
    return tee.windows(spark, rows.schema)


@register(
    "stream_eviction",
    f"""{WITH_EV}, e AS (
      SELECT time_bucket(INTERVAL '10 minutes', collected_at) + INTERVAL '10 minutes' AS tick,
        1 AS arrived, 0 AS evicted FROM ev
      UNION ALL SELECT time_bucket(INTERVAL '10 minutes', collected_at + INTERVAL '1 hour')
        + INTERVAL '10 minutes', 0, 1 FROM ev)
    SELECT tick, CAST(sum(arrived) AS BIGINT) AS arrived, CAST(sum(evicted) AS BIGINT) AS evicted
    FROM e GROUP BY tick""",
)
def stream_eviction(spark, d):
    """Rows that a trailing hour takes in and evicts, per tick of ten minutes."""
    path, checkpoint = _folders(spark, "eviction")
    rows = adapters.ev_stream(spark, d, closing=F.lit(True))
    ticks = streaming.eviction_stream(rows, "1 hour", "10 minutes", "1 day", SPEC)
    _finish(streaming.to_parquet(ticks, path, checkpoint))
    return spark.read.parquet(path).withColumn("tick", utc_naive(F.col("tick")))


@register("window_side_output", HYBRID_SQL)
def window_side_output(spark, d):
    """Window aggregates as NDJSON next to the raw output."""
    raw = scratch(spark, "raw") + "/raw.ndjson"
    rows = _with_shard(events(spark, d))
    found = windows.hybrid_windows(rows, "6 hours", 12, ["shard"], SPEC)
    for _ in range(2):  # a replay adds nothing
        sinks.append_aggregates(found, raw, batch_id=0)
    return sinks.committed_aggregates(spark, raw, found.schema)


@register(
    "rejected_sink",
    f"""{WITH_DIRTY}, checked AS (SELECT *, {ERRORS_SQL} AS errors FROM dirty)
    SELECT seq, errors FROM checked WHERE errors <> ''""",
)
def rejected_sink(spark, d):
    """Rejected rows as NDJSON with all their errors."""
    path = scratch(spark, "rejected") + ".ndjson"
    checked = validate.validate(adapters.dirty(spark, d), RULES, SPEC)
    record = F.struct("seq", "region", "year", "indicator")
    sinks.write_rejected(checked.where(~F.col("valid")).select(record.alias("record"), "errors"), path)
    shape_of = "record struct<seq:bigint,region:string,year:int,indicator:string>, errors array<string>"
    stored = spark.read.schema(shape_of).json(path)
    return stored.select("record.seq", F.array_join("errors", " | ").alias("errors"))


@register(
    "first_lines",
    f"""{WITH_OBS} SELECT region, federal_district, CAST(year AS BIGINT) AS year, indicator, value,
    collected_at FROM obs ORDER BY seq LIMIT 100""",
)
def first_lines(spark, d):
    """The first 100 lines of an NDJSON file."""
    path = scratch(spark, "lines") + ".ndjson"
    ordered = panel(spark, d).repartitionByRange(8, "seq").sortWithinPartitions("seq")
    sinks.append_ndjson(_zoned_records(ordered), path)
    return _naive(sources.first_records(spark, path, 100), "collected_at")


@register(
    "kpi_captions",
    f"""{WITH_OBS}, y AS (SELECT max(year) AS y FROM obs WHERE indicator = '2-HIGH'),
    s AS (SELECT any_value(y) AS y, {sum2()} / 1000000 AS total, {avg2()} AS mean FROM obs, y
          WHERE indicator = '2-HIGH' AND year = y)
    SELECT format('{{:.1f}} млн (за {{}})', total, y) AS total,
        format('{{:.1f}} лет (за {{}})', mean, y) AS mean, '—' AS absent FROM s""",
)
def kpi_captions(spark, d):
    rows = panel(spark, d)
    captions = {
        "total": reports.total_label(aggregate.kpi_total(rows, "2-HIGH", spec=SPEC)),
        "mean": reports.mean_label(aggregate.kpi_mean(rows, "2-HIGH", SPEC)),
        "absent": reports.total_label(aggregate.kpi_total(rows, "nowhere", spec=SPEC)),
    }
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in captions.items()])


# --- whole pipeline ----------------------------------------------------------

PIPELINE_CLEANED = CLEAN_CTE.replace(
    "year BETWEEN 1990 AND 2030 AND isfinite", "year BETWEEN 1996 AND 2000 AND isfinite"
)


@register(
    "panel_pipeline",
    f"""{PIPELINE_CLEANED}, checked AS (SELECT *, {ERRORS_SQL} AS errors FROM cleaned)
    SELECT federal_district, indicator, {GROUP_STATS_SQL} FROM checked WHERE errors = ''
    GROUP BY 1, 2""",
)
def panel_pipeline(spark, d):
    return analyze.flagship(adapters.dirty(spark, d), RULES, SPEC)


@register("pipeline_stored", ORACLES["panel_pipeline"])
def pipeline_stored(spark, d):
    return analyze.analyze(spark, adapters.dirty(spark, d), rules=RULES, spec=SPEC).by_group

