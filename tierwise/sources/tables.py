"""Trip, zone and station-day inputs derived from the star-schema tables.

The mapping is described in FIXTURES.md section 2; it is plain projection over
`lineitem`, `orders`, `nation` and `region`, so every query works on whole
tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.session import configure

_TRIP_COLUMNS = {
    "VendorID": "l_suppkey % 2 + 1",
    "tpep_pickup_datetime": "pickup",
    "tpep_dropoff_datetime": """timestampadd(SECOND,
        CAST(CASE WHEN l_orderkey % 50 = 0 THEN -60D WHEN l_orderkey % 53 = 0 THEN 90000D
             ELSE l_quantity * 180 + l_linenumber * 7 - 150 END AS BIGINT), pickup)""",
    "passenger_count": "CASE WHEN l_partkey % 97 != 0 THEN CAST(l_linenumber AS DOUBLE) END",
    "trip_distance": "CASE WHEN l_orderkey % 61 = 0 THEN -1D ELSE l_quantity / 2 END",
    "RatecodeID": "l_orderkey % 6 + 1",
    "store_and_fwd_flag": "CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END",
    "PULocationID": "l_partkey % 27 + 1",
    "DOLocationID": "l_suppkey % 27 + 1",
    "payment_type": "CAST(priority AS BIGINT)",
    "fare_amount": "CASE WHEN l_orderkey % 67 = 0 THEN -l_extendedprice / 200"
    " ELSE l_extendedprice / 200 END",
    "extra": "CAST(l_linenumber % 3 AS DOUBLE) / 2",
    "mta_tax": "0.5D",
    "tip_amount": "l_extendedprice / 200 * l_discount",
    "tolls_amount": "l_tax * 100",
    "improvement_surcharge": "0.3D",
    "total_amount": "l_extendedprice / 200 * (1 + l_discount) + l_tax * 100 + 0.8D",
    "congestion_surcharge": "2.5D",
    "airport_fee": "CASE WHEN l_partkey % 27 < 2 THEN 1.25D ELSE 0D END",
    "source_year": "CAST(year(l_shipdate) AS SMALLINT)",
    "source_month": "CAST(month(l_shipdate) AS TINYINT)",
}
_PICKUP = """timestampadd(MINUTE,
    (l_partkey % 24) * 60 + l_orderkey % 60 + CASE WHEN l_orderkey % 59 = 0 THEN 46080 ELSE 0 END,
    l_shipdate)"""

_BASE_TEMP = "(CAST((o_orderkey * 7) % 1500 AS DOUBLE) / 10 - 20)"
_STATION = "CAST(o_custkey % 50 AS DOUBLE)"
_WEATHER_COLUMNS = {
    "STATION": "concat('S', lpad(CAST(o_custkey % 50 AS STRING), 3, '0'))",
    "DATE": "CAST(o_orderdate AS DATE)",
    "LATITUDE": f"CASE WHEN o_orderkey % 211 = 0 THEN 95D ELSE {_STATION} * 3 - 70 END",
    "LONGITUDE": f"{_STATION} * 7 - 170",
    "ELEVATION": f"CASE WHEN o_orderkey % 223 != 0 THEN {_STATION} * 40 - 100.5D END",
    "NAME": "concat('STATION ', CAST(o_custkey % 50 AS STRING))",
    "TEMP": f"CASE WHEN o_orderkey % 101 = 0 THEN 9999.9D ELSE {_BASE_TEMP} END",
    "DEWP": f"CASE WHEN o_orderkey % 109 = 0 THEN 9999.9D ELSE {_BASE_TEMP} - 10 END",
    "SLP": "CAST(1000 + o_orderkey % 30 AS DOUBLE)",
    "STP": "CAST(990 + o_orderkey % 30 AS DOUBLE)",
    "VISIB": "CASE WHEN o_orderkey % 113 = 0 THEN 999.9D ELSE CAST(o_orderkey % 100 AS DOUBLE) / 10 END",
    "WDSP": "CASE WHEN o_orderkey % 103 = 0 THEN 999.9D ELSE CAST(o_orderkey % 450 AS DOUBLE) / 10 END",
    "MXSPD": "CASE WHEN o_orderkey % 127 = 0 THEN 999.9D ELSE CAST(o_orderkey % 600 AS DOUBLE) / 10 END",
    "GUST": "CASE WHEN o_orderkey % 4 = 0 THEN 999.9D ELSE CAST(o_orderkey % 800 AS DOUBLE) / 10 END",
    "MAX": f"{_BASE_TEMP} + 8",
    "MIN": f"CASE WHEN o_orderkey % 131 = 0 THEN {_BASE_TEMP} + 20 ELSE {_BASE_TEMP} - 8 END",
    "PRCP": "CASE WHEN o_orderkey % 107 = 0 THEN 99.99D WHEN o_orderkey % 3 = 0 THEN 0D"
    " ELSE CAST(o_orderkey % 650 AS DOUBLE) / 100 END",
    "SNDP": "CASE WHEN o_orderkey % 5 = 0 THEN 999.9D ELSE CAST(o_orderkey % 40 AS DOUBLE) / 10 END",
    "FRSHTT": "'000000'",
    "source_year": "CAST(year(o_orderdate) AS SMALLINT)",
    "source_month": "CAST(month(o_orderdate) AS TINYINT)",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS `{name}`" for name, expression in columns.items()])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trips, one row per order line, with their batch columns.

    Both sides grow with the data, so neither is broadcast, however small a
    test set may make one of them; Spark splits hot order keys at run time. A
    task hashes its share of the orders, so that no lines are sorted; of an order
    it holds the key and the digit of its priority.
    """
    lines = table(spark, sf_dir, "lineitem")
    priority = "CAST(substr(o_orderpriority, 1, 1) AS TINYINT) AS priority"
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", priority)
    joined = lines.join(orders.hint("shuffle_hash"), F.expr("l_orderkey = o_orderkey"))
    return _project(joined.withColumn("pickup", F.expr(_PICKUP)), _TRIP_COLUMNS)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension: id, borough, zone name and service zone."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, F.expr("n_regionkey = r_regionkey")).selectExpr(
        "n_nationkey + 1 AS LocationID",
        "r_name AS Borough",
        "n_name AS Zone",
        "CASE r_regionkey WHEN 0 THEN 'Airports' WHEN 1 THEN 'Yellow Zone' ELSE 'Boro Zone' END"
        " AS service_zone",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw station days, one row per order, with their batch columns."""
    return _project(table(spark, sf_dir, "orders"), _WEATHER_COLUMNS)


def weather_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one row per station and day: that of the smallest order key."""
    orders = table(spark, sf_dir, "orders")
    first = orders.groupBy(F.expr("o_custkey % 50"), "o_orderdate").agg(F.min("o_orderkey").alias("first_key"))
    return _project(orders.join(first, F.expr("o_orderkey = first_key"), "left_semi"), _WEATHER_COLUMNS)
