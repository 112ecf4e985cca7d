"""Cleaned, narrowed and enriched rows, and the staging renames on top."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions import (
    day_name,
    day_of_week,
    minutes_between,
    number,
    round2,
    whole,
)
from tierwise.operators.rules import keep, trip_rules, weather_rules

# Payment codes. Other codes have no name.
PAYMENT_METHODS = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided",
}

# Months of the northern seasons.
SEASONS = {
    "winter": (12, 1, 2),
    "spring": (3, 4, 5),
    "summer": (6, 7, 8),
    "fall": (9, 10, 11),
}

KMH_PER_KNOT = 1.852
FREEZING_F, EXTREME_HEAT_F, GALE_KNOTS = 32.0, 100.0, 34.0

WEATHER_METRICS = (
    "TEMP",
    "DEWP",
    "SLP",
    "STP",
    "VISIB",
    "WDSP",
    "MXSPD",
    "GUST",
    "MAX",
    "MIN",
    "PRCP",
    "SNDP",
)

# Markers that mean "not measured" in columns the row rules do not clean.
STRICT_SENTINELS = {
    "DEWP": 9999.9,
    "SLP": 9999.9,
    "STP": 9999.9,
    "MAX": 9999.9,
    "MIN": 9999.9,
    "MXSPD": 999.9,
    "GUST": 999.9,
    "SNDP": 999.9,
}


def silver_trips(bronze: DataFrame, processed_at: str = "current_timestamp()") -> DataFrame:
    """Clean trips with derived columns; one plan for any number of batches."""
    pickup = "tpep_pickup_datetime"
    methods = " ".join(f"WHEN {code} THEN '{name}'" for code, name in PAYMENT_METHODS.items())
    cleaned = keep(bronze, trip_rules()).withColumns(
        {
            "trip_duration_minutes": F.expr(minutes_between(pickup, "tpep_dropoff_datetime")),
            "pickup_day_of_week": F.expr(day_of_week(pickup)),
        }
    )
    return cleaned.selectExpr(
        "VendorID",
        "tpep_pickup_datetime",
        "tpep_dropoff_datetime",
        f"{whole('passenger_count', 'SMALLINT')} AS passenger_count",
        "CAST(trip_distance AS FLOAT) AS trip_distance",
        "try_cast(PULocationID AS INT) AS PULocationID",
        "try_cast(DOLocationID AS INT) AS DOLocationID",
        "try_cast(payment_type AS SMALLINT) AS payment_type",
        "CAST(fare_amount AS FLOAT) AS fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        "congestion_surcharge",
        "airport_fee",
        "store_and_fwd_flag",
        "RatecodeID",
        "source_year",
        "source_month",
        "source_file",
        "ingested_at",
        "trip_duration_minutes",
        "pickup_day_of_week",
        "CASE WHEN trip_duration_minutes > 0"
        " THEN CAST(trip_distance / (trip_duration_minutes / 60D) AS FLOAT) END AS trip_speed_mph",
        f"CAST(hour({pickup}) AS SMALLINT) AS pickup_hour",
        f"{processed_at} AS processed_at",
        f"CASE payment_type {methods} END AS payment_method",
        f"{day_name(pickup)} AS day_name",
        "coalesce(pickup_day_of_week IN (0, 6), FALSE) AS is_weekend",
        f"CAST({pickup} AS DATE) AS pickup_date",
    )


def without_sentinels(bronze: DataFrame) -> DataFrame:
    """Optional step before `silver_weather`: unmeasured values become null
    instead of entering averages and records, or costing the whole row."""
    return bronze.withColumns(
        {
            c: F.expr(f"CASE WHEN {number(f'`{c}`')} < {limit}D THEN `{c}` END")
            for c, limit in STRICT_SENTINELS.items()
        }
    )


def _celsius(c: str) -> str:
    return round2(f"({number(f'`{c}`')} - 32) * 5D / 9D")


def _kmh(c: str) -> str:
    return round2(f"{number(c)} * {KMH_PER_KNOT}D")


def silver_weather(
    bronze: DataFrame,
    processed_at: str = "current_timestamp()",
    today: str = "current_date()",
    strict_sentinels: bool = False,
) -> DataFrame:
    """Clean station days with unit conversions and event flags."""
    date = "try_cast(`DATE` AS DATE)"
    seasons = " ".join(
        f"WHEN month({date}) IN ({', '.join(map(str, months))}) THEN '{name}'"
        for name, months in SEASONS.items()
    )
    cleaned = keep(
        without_sentinels(bronze) if strict_sentinels else bronze, weather_rules(today)
    )
    return cleaned.selectExpr(
        "CAST(STATION AS STRING) AS STATION",
        f"{date} AS `DATE`",
        f"CAST({number('LATITUDE')} AS FLOAT) AS LATITUDE",
        f"CAST({number('LONGITUDE')} AS FLOAT) AS LONGITUDE",
        f"{whole('ELEVATION', 'SMALLINT')} AS ELEVATION",
        "CAST(NAME AS STRING) AS NAME",
        *[f"CAST({number(f'`{c}`')} AS FLOAT) AS `{c}`" for c in WEATHER_METRICS],
        "source_year",
        "source_month",
        "source_file",
        "ingested_at",
        f"CASE {seasons} END AS season_northern",
        f"{day_name(date)} AS day_name",
        f"coalesce({day_of_week(date)} IN (0, 6), FALSE) AS is_weekend",
        f"{_celsius('TEMP')} AS temp_c",
        f"{_celsius('MAX')} AS max_temp_c",
        f"{_celsius('MIN')} AS min_temp_c",
        f"{_kmh('WDSP')} AS wdsp_kmh",
        f"{_kmh('MXSPD')} AS mxspd_kmh",
        f"{_kmh('GUST')} AS gust_kmh",
        f"{number('TEMP')} <= {FREEZING_F}D AS is_freezing",
        f"{number('TEMP')} >= {EXTREME_HEAT_F}D AS is_extreme_heat",
        f"{number('PRCP')} > 0 AS has_precipitation",
        f"{number('WDSP')} >= {GALE_KNOTS}D AS is_gale",
        f"{processed_at} AS processed_at",
    )


# Staging names, where they differ from the Silver ones.
TRIP_STAGING_NAMES = {
    "VendorID": "vendor_id",
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "RatecodeID": "rate_code_id",
    "ingested_at": "bronze_ingested_at",
    "processed_at": "silver_processed_at",
}
WEATHER_STAGING_NAMES = {
    "STATION": "station",
    "DATE": "date",
    "LATITUDE": "latitude",
    "LONGITUDE": "longitude",
    "ELEVATION": "elevation",
    "NAME": "station_name",
    "TEMP": "temp_f",
    "DEWP": "dewp_f",
    "SLP": "slp_hpa",
    "STP": "stp_hpa",
    "VISIB": "visib_mi",
    "WDSP": "wdsp_kts",
    "MXSPD": "mxspd_kts",
    "GUST": "gust_kts",
    "MAX": "max_temp_f",
    "MIN": "min_temp_f",
    "PRCP": "prcp_in",
    "SNDP": "sndp_in",
}


def stage_trips(silver: DataFrame) -> DataFrame:
    return silver.withColumnsRenamed(TRIP_STAGING_NAMES)


def stage_weather(silver: DataFrame) -> DataFrame:
    return silver.withColumnsRenamed(WEATHER_STAGING_NAMES)


def new_columns(before: DataFrame, after: DataFrame) -> DataFrame:
    """Columns of `after` that `before` lacks: name, type and filled rows, from
    one aggregation."""
    old = set(before.columns)
    added = {f.name: f.dataType.simpleString() for f in after.schema.fields if f.name not in old}
    if not added:
        return after.sparkSession.createDataFrame([], "name STRING, type STRING, filled BIGINT")
    fields = ", ".join(f"named_struct('name', '{n}', 'type', '{t}', 'filled', `{n}`)" for n, t in added.items())
    return after.agg(*[F.count(n).alias(n) for n in added]).selectExpr(f"inline(array({fields}))")
