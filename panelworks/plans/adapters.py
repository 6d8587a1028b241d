"""Panel views over star-schema and event tables.

``obs`` reads orders as a panel (nation, world region, year, priority, price) and
``orders_panel`` is the same without places; ``customers`` takes the customer as
entity, ``shipments`` reads line items, ``ev`` reads events as a stream of records.
Joins carry no hints: dimensions are small by statistics, not by promise, so the
planner decides from their actual size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelworks.schema import PanelSpec
from panelworks.session import scratch
from panelworks.streaming import closing_record

# Prices and event values have two decimals, so sums are exact in DECIMAL.
SPEC = PanelSpec(scale=2)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _with_places(rows: DataFrame, spark: SparkSession, folder: str, nation_key: str) -> DataFrame:
    """Add nation and world region.

    Joined one table at a time onto the rows: each right side is then a scan whose
    size is known, whereas the size of a joined dimension is only guessed (as a
    product) and the large side might be shuffled or even broadcast for it.
    """
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return rows.join(nation, F.col(nation_key) == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def obs(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return _with_places(placed, spark, folder, "c_nationkey").select(
        F.col("n_name").alias("region"),
        F.col("r_name").alias("federal_district"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("indicator"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderdate").alias("collected_at"),
        F.col("o_orderkey").alias("seq"),
    )


OBS_SQL = """
    SELECT n_name AS region, r_name AS federal_district,
           CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS indicator,
           o_totalprice AS value, o_orderdate AS collected_at, o_orderkey AS seq
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def orders_panel(spark: SparkSession, folder: str) -> DataFrame:
    """``obs`` without places, for reports that ask for none: no join at all."""
    return table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("indicator"),
        F.col("o_totalprice").alias("value"),
        F.col("o_orderdate").alias("collected_at"),
        F.col("o_orderkey").alias("seq"),
    )


ORDERS_SQL = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS indicator,
           o_totalprice AS value, o_orderdate AS collected_at, o_orderkey AS seq
    FROM orders
"""


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """A sparse panel: the customer is the entity."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("region"),
        F.year("o_orderdate").alias("year"),
        F.col("o_orderpriority").alias("indicator"),
        F.col("o_totalprice").alias("value"),
    )


CUSTOMERS_SQL = """
    SELECT CAST(o_custkey AS VARCHAR) AS region, CAST(year(o_orderdate) AS INTEGER) AS year,
           o_orderpriority AS indicator, o_totalprice AS value FROM orders
"""


def shipments(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    supplier = table(spark, folder, "supplier")
    placed = lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return _with_places(placed, spark, folder, "s_nationkey").select(
        F.col("n_name").alias("region"),
        F.col("r_name").alias("federal_district"),
        F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("indicator"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_shipdate").alias("collected_at"),
    )


SHIPMENTS_SQL = """
    SELECT n_name AS region, r_name AS federal_district,
           CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS indicator,
           l_extendedprice AS value, l_shipdate AS collected_at
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""


def as_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").alias("region"),
        F.col("event_type").alias("indicator"),
        F.col("value"),
        F.col("ts").alias("collected_at"),
        F.col("event_id").alias("seq"),
    )


def ev(spark: SparkSession, folder: str) -> DataFrame:
    return as_events(table(spark, folder, "events"))


EV_SQL = """
    SELECT CAST(user_id AS VARCHAR) AS region, event_type AS indicator, value,
           ts AS collected_at, event_id AS seq
    FROM events
"""


STREAM_FILES = 6


def ev_stream(spark: SparkSession, folder: str, closing: Column | None = None) -> DataFrame:
    """The events as a stream of several files in time order, one per micro-batch.

    With ``closing``, a last file holds a record far ahead of the latest event that meets this
    condition, which closes all windows.
    """
    rows = table(spark, folder, "events")
    path = scratch(spark, "events")
    first, last = rows.agg(F.min("ts").cast("string"), F.max("ts").cast("string")).first()
    start, end = F.lit(first).cast("timestamp"), F.lit(last).cast("timestamp")
    share = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(start)) / F.greatest(
        F.unix_micros(end) - F.unix_micros(start), F.lit(1)
    )
    part = F.least(F.floor(share * STREAM_FILES), F.lit(STREAM_FILES - 1))
    for n in range(STREAM_FILES):
        rows.where(part == n).coalesce(1).write.mode("append").parquet(path)
    if closing is not None:
        ahead = closing_record(rows.where(closing), spec=PanelSpec(at="ts"))
        ahead.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    return as_events(reader.parquet(path))


def _every(n: int) -> Column:
    return F.col("seq") % n == 0


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    """``obs`` with deterministic faults: nulls, blanks, NaN, infinity, bad years,
    unknown and service indicators."""
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return obs(spark, folder).withColumns(
        {
            "region": F.when(_every(7), F.lit(None))
            .when(_every(31), F.lit("  "))
            .otherwise(F.col("region")),
            "year": F.when(_every(13), F.lit(1989))
            .when(_every(37), F.lit(2031))
            .otherwise(F.col("year")),
            "indicator": F.when(_every(19), F.lit(None))
            .when(_every(23), F.concat(F.lit("_agg_"), F.col("indicator")))
            .when(_every(41), F.lit(""))
            .otherwise(F.col("indicator")),
            "value": F.when(_every(11), nan)
            .when(_every(29), inf)
            .when(_every(43), F.lit(None))
            .otherwise(F.col("value")),
        }
    )


DIRTY_SQL = f"""
    SELECT CASE WHEN seq % 7 = 0 THEN NULL WHEN seq % 31 = 0 THEN '  ' ELSE region END AS region,
           federal_district,
           CAST(CASE WHEN seq % 13 = 0 THEN 1989 WHEN seq % 37 = 0 THEN 2031 ELSE year END
                AS INTEGER) AS year,
           CASE WHEN seq % 19 = 0 THEN NULL WHEN seq % 23 = 0 THEN '_agg_' || indicator
                WHEN seq % 41 = 0 THEN '' ELSE indicator END AS indicator,
           CASE WHEN seq % 11 = 0 THEN CAST('nan' AS DOUBLE)
                WHEN seq % 29 = 0 THEN CAST('infinity' AS DOUBLE)
                WHEN seq % 43 = 0 THEN NULL ELSE value END AS value,
           collected_at, seq
    FROM ({OBS_SQL})
"""


def json_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``obs`` as JSON lines with deterministic faults: absent, null and mistyped
    fields, cut lines."""

    def part(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), text)

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    def fixed(text: str) -> Column:
        return F.lit(text)

    region = (
        F.when(_every(11), fixed('"x":1'))
        .when(_every(13), part("region", fixed("42")))
        .when(_every(37), part("region", fixed("null")))
        .when(_every(43), part("region", fixed('"   "')))
        .otherwise(part("region", quoted(F.col("region"))))
    )
    year_text = F.col("year").cast("string")
    year = (
        F.when(_every(17), part("year", quoted(year_text)))
        .when(_every(19), part("year", F.concat(year_text, F.lit(".0"))))
        .when(_every(47), fixed('"y":1'))
        .otherwise(part("year", year_text))
    )
    indicator = (
        F.when(_every(41), part("indicator", fixed('""')))
        .when(_every(53), part("indicator", fixed("[1]")))
        .otherwise(part("indicator", quoted(F.col("indicator"))))
    )
    value = (
        F.when(_every(23), part("value", fixed('"abc"')))
        .when(_every(29), part("value", fixed("true")))
        .when(_every(59), fixed('"v":1'))
        .otherwise(part("value", F.col("value").cast("decimal(18,2)").cast("string")))
    )
    whole = F.concat(
        F.lit("{"), F.concat_ws(",", region, year, indicator, value), F.lit("}")
    )
    line = F.when(_every(31), F.substring(whole, 1, 20)).otherwise(whole)
    return obs(spark, folder).select(line.alias("value"), "seq")


JSON_SQL = f"""
    SELECT CASE WHEN seq % 31 = 0 THEN substr(whole, 1, 20) ELSE whole END AS line, seq
    FROM (
      SELECT seq, '{{' || concat_ws(',',
        CASE WHEN seq % 11 = 0 THEN '"x":1' WHEN seq % 13 = 0 THEN '"region":42'
             WHEN seq % 37 = 0 THEN '"region":null' WHEN seq % 43 = 0 THEN '"region":"   "'
             ELSE '"region":"' || region || '"' END,
        CASE WHEN seq % 17 = 0 THEN '"year":"' || CAST(year AS VARCHAR) || '"'
             WHEN seq % 19 = 0 THEN '"year":' || CAST(year AS VARCHAR) || '.0'
             WHEN seq % 47 = 0 THEN '"y":1' ELSE '"year":' || CAST(year AS VARCHAR) END,
        CASE WHEN seq % 41 = 0 THEN '"indicator":""' WHEN seq % 53 = 0 THEN '"indicator":[1]'
             ELSE '"indicator":"' || indicator || '"' END,
        CASE WHEN seq % 23 = 0 THEN '"value":"abc"' WHEN seq % 29 = 0 THEN '"value":true'
             WHEN seq % 59 = 0 THEN '"v":1'
             ELSE '"value":' || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END
      ) || '}}' AS whole
      FROM ({OBS_SQL})
    )
"""
