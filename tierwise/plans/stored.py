"""Tables that several queries read, written once per application.

They live in the shared folder; a query that needs one names it here, and the
first to ask writes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.operators.bronze import audit_weather
from tierwise.operators.silver import silver_trips
from tierwise.operators.versions import VersionedTable
from tierwise.plans import layers, pipeline
from tierwise.schemas import WEATHER_SOURCE
from tierwise.session import configure, fresh_dir
from tierwise.sources import tables

_made: dict[tuple[str, str, str], object] = {}

# Row bounds for the gates of the small test tables.
GATE_ROWS = (500, 10**12)


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _made:
        configure(spark)
        _made[key] = make()
    return _made[key]


def bronze_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Bronze trips, partitioned by month."""

    def make() -> VersionedTable:
        made = VersionedTable(spark, fresh_dir(spark, "bronze-trips"))
        made.commit(layers.bronze_trips(spark, sf_dir))
        return made

    return _once(spark, sf_dir, "bronze", make)


def silver_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Silver trips, cleaned from the Bronze table."""

    def make() -> VersionedTable:
        made = VersionedTable(spark, fresh_dir(spark, "silver-trips"))
        made.commit(silver_trips(bronze_table(spark, sf_dir).read()), laid_out=True)
        return made

    return _once(spark, sf_dir, "silver", make)


def silver_weather_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Silver station days."""

    def make() -> VersionedTable:
        made = VersionedTable(spark, fresh_dir(spark, "silver-weather"))
        made.commit(layers.clean_weather(spark, sf_dir))
        return made

    return _once(spark, sf_dir, "silver-weather", make)


def revised_trips(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Bronze trips with a history of replacements:

    0 creates the table, without the airport fee column;
    1 replaces June 1996, distances doubled;
    2 replaces 1997, without its March;
    3 replaces January 1998 with rows that have an airport fee;
    4 replaces both June 1996 and January 1998 in one step, the fee column
      spelled differently and the passenger count an integer.
    """

    def make() -> VersionedTable:
        made = VersionedTable(spark, fresh_dir(spark, "revised-trips"))
        # Lines and orders are joined once, for the Bronze table: a join per replacement
        # would hash all orders again, in few tasks as there are few lines.
        rows = bronze_table(spark, sf_dir).read()
        early = rows.drop("airport_fee")
        made.commit(early, operation="CREATE", laid_out=True)
        made.commit(
            early.where("source_year = 1996 AND source_month = 6").withColumn(
                "trip_distance", F.col("trip_distance") * 2
            ),
            replace=[(1996, 6)],
            laid_out=True,
        )
        made.commit(
            early.where("source_year = 1997 AND source_month != 3"), replace=[(1997, None)], laid_out=True
        )
        made.commit(rows.where("source_year = 1998 AND source_month = 1"), replace=[(1998, 1)], laid_out=True)
        both = "(source_year = 1996 AND source_month = 6) OR (source_year = 1998 AND source_month = 1)"
        made.commit(
            rows.where(both)
            .withColumn("passenger_count", F.col("passenger_count").cast("int"))
            .withColumnRenamed("airport_fee", "Airport_Fee"),
            replace=[(1996, 6), (1998, 1)],
            laid_out=True,
        )
        return made

    return _once(spark, sf_dir, "revised", make)


def trip_pipeline(spark: SparkSession, sf_dir: str) -> pipeline.Medallion:
    def make() -> pipeline.Medallion:
        return pipeline.run_trips(
            spark,
            tables.trips(spark, sf_dir),
            tables.zones(spark, sf_dir),
            fresh_dir(spark, "medallion"),
            pipeline.trip_domain(GATE_ROWS, GATE_ROWS),
        )

    return _once(spark, sf_dir, "trip-pipeline", make)


def undated_days(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Bronze station days, some of them with an unreadable date and so without
    a month: 0 creates the table, 1 replaces 1995 with its readable days."""

    def make() -> VersionedTable:
        made = VersionedTable(spark, fresh_dir(spark, "undated-days"))
        days = tables.weather(spark, sf_dir).withColumn("DATE", F.col("DATE").cast("string"))
        unreadable = F.expr("STATION IN ('S007', 'S008') AND TEMP > 50")
        broken = days.withColumn("DATE", F.when(unreadable, F.lit("someday")).otherwise(F.col("DATE")))
        made.commit(audit_weather(broken))
        made.commit(audit_weather(broken.where(~unreadable & (F.col("source_year") == 1995))), replace=[(1995, None)])
        return made

    return _once(spark, sf_dir, "undated", make)


def full_weather(days: DataFrame) -> DataFrame:
    """Raw station days with all contract columns, as read from archives."""
    absent = {c: F.lit(None).cast("string") for c in WEATHER_SOURCE if c not in days.columns}
    return days.withColumns(absent)


def weather_pipeline(spark: SparkSession, sf_dir: str, once: bool = True) -> pipeline.Medallion:
    """The pipeline over one row per station day; or, not `once`, over rows that
    report a station several times a day, which the Silver suite stops."""

    def make() -> pipeline.Medallion:
        days = tables.weather_once(spark, sf_dir) if once else tables.weather(spark, sf_dir)
        return pipeline.run_weather(
            spark,
            full_weather(days),
            fresh_dir(spark, "medallion"),
            pipeline.weather_domain(GATE_ROWS, GATE_ROWS),
        )

    return _once(spark, sf_dir, "weather-pipeline" if once else "weather-stopped", make)
