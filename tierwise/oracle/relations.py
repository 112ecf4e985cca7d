"""Named subqueries the oracle statements are put together from."""

from __future__ import annotations

TRIPS = """
    SELECT
        l_suppkey % 2 + 1 AS "VendorID",
        pickup AS tpep_pickup_datetime,
        pickup + to_seconds(CAST(CASE WHEN l_orderkey % 50 = 0 THEN -60
                                      WHEN l_orderkey % 53 = 0 THEN 90000
                                      ELSE l_quantity * 180 + l_linenumber * 7 - 150 END AS BIGINT))
            AS tpep_dropoff_datetime,
        CAST(CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_linenumber END AS DOUBLE) AS passenger_count,
        CASE WHEN l_orderkey % 61 = 0 THEN CAST(-1.0 AS DOUBLE) ELSE l_quantity / 2 END AS trip_distance,
        l_orderkey % 6 + 1 AS "RatecodeID",
        CASE WHEN l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        l_partkey % 27 + 1 AS "PULocationID",
        l_suppkey % 27 + 1 AS "DOLocationID",
        CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS payment_type,
        CASE WHEN l_orderkey % 67 = 0 THEN -l_extendedprice / 200 ELSE l_extendedprice / 200 END
            AS fare_amount,
        CAST(l_linenumber % 3 AS DOUBLE) / 2 AS extra,
        CAST(0.5 AS DOUBLE) AS mta_tax,
        l_extendedprice / 200 * l_discount AS tip_amount,
        l_tax * 100 AS tolls_amount,
        CAST(0.3 AS DOUBLE) AS improvement_surcharge,
        l_extendedprice / 200 * (1 + l_discount) + l_tax * 100 + CAST(0.8 AS DOUBLE) AS total_amount,
        CAST(2.5 AS DOUBLE) AS congestion_surcharge,
        CASE WHEN l_partkey % 27 < 2 THEN CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS airport_fee,
        CAST(year(l_shipdate) AS SMALLINT) AS source_year,
        CAST(month(l_shipdate) AS TINYINT) AS source_month
    FROM (
        SELECT *, l_shipdate + to_minutes(CAST((l_partkey % 24) * 60 + l_orderkey % 60
            + CASE WHEN l_orderkey % 59 = 0 THEN 46080 ELSE 0 END AS BIGINT)) AS pickup
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ) lines"""

ZONES = """
    SELECT CAST(n_nationkey + 1 AS INTEGER) AS "LocationID", r_name AS "Borough", n_name AS "Zone",
        CASE WHEN r_regionkey = 0 THEN 'Airports' WHEN r_regionkey = 1 THEN 'Yellow Zone'
             ELSE 'Boro Zone' END AS service_zone
    FROM nation JOIN region ON n_regionkey = r_regionkey"""

WEATHER = """
    SELECT
        'S' || lpad(CAST(o_custkey % 50 AS VARCHAR), 3, '0') AS "STATION",
        CAST(o_orderdate AS DATE) AS "DATE",
        CASE WHEN o_orderkey % 211 = 0 THEN CAST(95 AS DOUBLE)
             ELSE CAST(o_custkey % 50 AS DOUBLE) * 3 - 70 END AS "LATITUDE",
        CAST(o_custkey % 50 AS DOUBLE) * 7 - 170 AS "LONGITUDE",
        CASE WHEN o_orderkey % 223 = 0 THEN NULL
             ELSE CAST(o_custkey % 50 AS DOUBLE) * 40 - CAST(100.5 AS DOUBLE) END AS "ELEVATION",
        'STATION ' || CAST(o_custkey % 50 AS VARCHAR) AS "NAME",
        CASE WHEN o_orderkey % 101 = 0 THEN CAST(9999.9 AS DOUBLE) ELSE t0 END AS "TEMP",
        CASE WHEN o_orderkey % 109 = 0 THEN CAST(9999.9 AS DOUBLE) ELSE t0 - 10 END AS "DEWP",
        CAST(1000 + o_orderkey % 30 AS DOUBLE) AS "SLP",
        CAST(990 + o_orderkey % 30 AS DOUBLE) AS "STP",
        CASE WHEN o_orderkey % 113 = 0 THEN CAST(999.9 AS DOUBLE)
             ELSE CAST(o_orderkey % 100 AS DOUBLE) / 10 END AS "VISIB",
        CASE WHEN o_orderkey % 103 = 0 THEN CAST(999.9 AS DOUBLE)
             ELSE CAST(o_orderkey % 450 AS DOUBLE) / 10 END AS "WDSP",
        CASE WHEN o_orderkey % 127 = 0 THEN CAST(999.9 AS DOUBLE)
             ELSE CAST(o_orderkey % 600 AS DOUBLE) / 10 END AS "MXSPD",
        CASE WHEN o_orderkey % 4 = 0 THEN CAST(999.9 AS DOUBLE)
             ELSE CAST(o_orderkey % 800 AS DOUBLE) / 10 END AS "GUST",
        t0 + 8 AS "MAX",
        CASE WHEN o_orderkey % 131 = 0 THEN t0 + 20 ELSE t0 - 8 END AS "MIN",
        CASE WHEN o_orderkey % 107 = 0 THEN CAST(99.99 AS DOUBLE)
             WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE)
             ELSE CAST(o_orderkey % 650 AS DOUBLE) / 100 END AS "PRCP",
        CASE WHEN o_orderkey % 5 = 0 THEN CAST(999.9 AS DOUBLE)
             ELSE CAST(o_orderkey % 40 AS DOUBLE) / 10 END AS "SNDP",
        '000000' AS "FRSHTT",
        CAST(year(o_orderdate) AS SMALLINT) AS source_year,
        CAST(month(o_orderdate) AS TINYINT) AS source_month
    FROM (SELECT *, CAST((o_orderkey * 7) % 1500 AS DOUBLE) / 10 - 20 AS t0 FROM orders) days"""

# The same with one row per station and day.
WEATHER_ONCE = WEATHER.replace(
    "FROM orders)",
    "FROM orders QUALIFY o_orderkey = min(o_orderkey) OVER (PARTITION BY o_custkey % 50, o_orderdate))",
)

BRONZE_TRIPS = """
    SELECT *, printf('raw/taxi/%d-%02d.parquet', source_year, source_month) AS source_file FROM trips"""

BRONZE_WEATHER = """
    SELECT *, printf('raw/weather/%d.tar.gz', source_year) AS source_file FROM weather"""

# The rules by name, as conditions.
TRIP_RULES = {
    "required": "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"
    ' AND "PULocationID" IS NOT NULL AND "DOLocationID" IS NOT NULL AND fare_amount IS NOT NULL'
    " AND trip_distance IS NOT NULL AND passenger_count IS NOT NULL AND payment_type IS NOT NULL",
    "fare": "fare_amount > 0 AND fare_amount < 500",
    "distance": "trip_distance >= 0",
    "passengers": "passenger_count BETWEEN 1 AND 6",
    "time_order": "tpep_pickup_datetime < tpep_dropoff_datetime",
    "duration": "datediff('minute', tpep_pickup_datetime, tpep_dropoff_datetime) BETWEEN 1 AND 1440",
    "batch": "year(tpep_pickup_datetime) = source_year AND month(tpep_pickup_datetime) = source_month",
}
WEATHER_RULES = {
    "required": '"STATION" IS NOT NULL AND "DATE" IS NOT NULL AND "TEMP" IS NOT NULL'
    ' AND "WDSP" IS NOT NULL AND "VISIB" IS NOT NULL AND "PRCP" IS NOT NULL'
    ' AND "LATITUDE" IS NOT NULL AND "LONGITUDE" IS NOT NULL',
    "sentinel": '"TEMP" < CAST(9999.9 AS DOUBLE) AND "WDSP" < CAST(999.9 AS DOUBLE)'
    ' AND "PRCP" < CAST(99.99 AS DOUBLE) AND "VISIB" < CAST(999.9 AS DOUBLE)',
    "winter_snow": "source_month NOT IN (12, 1, 2)"
    ' OR ("SNDP" IS NOT NULL AND "SNDP" < CAST(999.9 AS DOUBLE))',
    "position": '"LATITUDE" BETWEEN -90 AND 90 AND "LONGITUDE" BETWEEN -180 AND 180'
    ' AND "ELEVATION" BETWEEN -500 AND 9000',
    "plausible": '"TEMP" BETWEEN -129 AND 135 AND "WDSP" BETWEEN 0 AND 200'
    ' AND "PRCP" BETWEEN 0 AND 6 AND "VISIB" BETWEEN 0 AND 999',
    "consistent": '("DEWP" IS NULL OR "DEWP" <= "TEMP")'
    ' AND ("MIN" IS NULL OR "MAX" IS NULL OR "MIN" <= "MAX")'
    ' AND ("MIN" IS NULL OR "MAX" IS NULL OR "TEMP" BETWEEN "MIN" AND "MAX")',
    "not_future": '"DATE" <= current_date',
    "batch": 'year("DATE") = source_year',
}


def _conjunction(rules: dict[str, str]) -> str:
    return "\n      AND ".join(f"({condition})" for condition in rules.values())


SILVER_TRIPS = f"""
    SELECT
        "VendorID", tpep_pickup_datetime, tpep_dropoff_datetime,
        CAST(passenger_count AS SMALLINT) AS passenger_count,
        CAST(trip_distance AS FLOAT) AS trip_distance,
        CAST("PULocationID" AS INTEGER) AS "PULocationID",
        CAST("DOLocationID" AS INTEGER) AS "DOLocationID",
        CAST(payment_type AS SMALLINT) AS payment_type,
        CAST(fare_amount AS FLOAT) AS fare_amount,
        extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount,
        congestion_surcharge, airport_fee, store_and_fwd_flag, "RatecodeID",
        source_year, source_month, source_file,
        trip_duration_minutes,
        CAST(dayofweek(tpep_pickup_datetime) AS SMALLINT) AS pickup_day_of_week,
        CASE WHEN trip_duration_minutes > 0
             THEN CAST(trip_distance / (trip_duration_minutes / CAST(60 AS DOUBLE)) AS FLOAT) END
            AS trip_speed_mph,
        CAST(hour(tpep_pickup_datetime) AS SMALLINT) AS pickup_hour,
        CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
             WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided' END AS payment_method,
        dayname(tpep_pickup_datetime) AS day_name,
        dayofweek(tpep_pickup_datetime) IN (0, 6) AS is_weekend,
        CAST(tpep_pickup_datetime AS DATE) AS pickup_date
    FROM (
        SELECT *, datediff('minute', tpep_pickup_datetime, tpep_dropoff_datetime)
            AS trip_duration_minutes
        FROM bronze_trips
    ) timed
    WHERE {_conjunction(TRIP_RULES)}"""

SILVER_WEATHER = f"""
    SELECT
        "STATION", "DATE", CAST("LATITUDE" AS FLOAT) AS "LATITUDE",
        CAST("LONGITUDE" AS FLOAT) AS "LONGITUDE", CAST("ELEVATION" AS SMALLINT) AS "ELEVATION", "NAME",
        CAST("TEMP" AS FLOAT) AS "TEMP", CAST("DEWP" AS FLOAT) AS "DEWP",
        CAST("SLP" AS FLOAT) AS "SLP", CAST("STP" AS FLOAT) AS "STP",
        CAST("VISIB" AS FLOAT) AS "VISIB", CAST("WDSP" AS FLOAT) AS "WDSP",
        CAST("MXSPD" AS FLOAT) AS "MXSPD", CAST("GUST" AS FLOAT) AS "GUST",
        CAST("MAX" AS FLOAT) AS "MAX", CAST("MIN" AS FLOAT) AS "MIN",
        CAST("PRCP" AS FLOAT) AS "PRCP", CAST("SNDP" AS FLOAT) AS "SNDP",
        source_year, source_month, source_file,
        CASE WHEN month("DATE") IN (12, 1, 2) THEN 'winter' WHEN month("DATE") IN (3, 4, 5) THEN 'spring'
             WHEN month("DATE") IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season_northern,
        dayname("DATE") AS day_name,
        dayofweek("DATE") IN (0, 6) AS is_weekend,
        round(("TEMP" - 32) * CAST(5 AS DOUBLE) / 9, 2) AS temp_c,
        round(("MAX" - 32) * CAST(5 AS DOUBLE) / 9, 2) AS max_temp_c,
        round(("MIN" - 32) * CAST(5 AS DOUBLE) / 9, 2) AS min_temp_c,
        round("WDSP" * CAST(1.852 AS DOUBLE), 2) AS wdsp_kmh,
        round("MXSPD" * CAST(1.852 AS DOUBLE), 2) AS mxspd_kmh,
        round("GUST" * CAST(1.852 AS DOUBLE), 2) AS gust_kmh,
        "TEMP" <= 32 AS is_freezing, "TEMP" >= 100 AS is_extreme_heat,
        "PRCP" > 0 AS has_precipitation, "WDSP" >= 34 AS is_gale
    FROM bronze_weather
    WHERE {_conjunction(WEATHER_RULES)}"""

STAGED_TRIPS = """
    SELECT "VendorID" AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
        tpep_dropoff_datetime AS dropoff_datetime, "PULocationID" AS pickup_location_id,
        "DOLocationID" AS dropoff_location_id, "RatecodeID" AS rate_code_id,
        * EXCLUDE ("VendorID", tpep_pickup_datetime, tpep_dropoff_datetime, "PULocationID",
                   "DOLocationID", "RatecodeID")
    FROM silver_trips"""

STAGED_WEATHER = """
    SELECT "STATION" AS station, "DATE" AS date, "LATITUDE" AS latitude, "LONGITUDE" AS longitude,
        "ELEVATION" AS elevation, "NAME" AS station_name, "TEMP" AS temp_f, "DEWP" AS dewp_f,
        "SLP" AS slp_hpa, "STP" AS stp_hpa, "VISIB" AS visib_mi, "WDSP" AS wdsp_kts,
        "MXSPD" AS mxspd_kts, "GUST" AS gust_kts, "MAX" AS max_temp_f, "MIN" AS min_temp_f,
        "PRCP" AS prcp_in, "SNDP" AS sndp_in,
        * EXCLUDE ("STATION", "DATE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "TEMP", "DEWP",
                   "SLP", "STP", "VISIB", "WDSP", "MXSPD", "GUST", "MAX", "MIN", "PRCP", "SNDP")
    FROM silver_weather"""

TRIPS_WITH_ZONES = """
    SELECT t.*, pu."Borough" AS pickup_borough, pu."Zone" AS pickup_zone,
        pu.service_zone AS pickup_service_zone, d."Borough" AS dropoff_borough, d."Zone" AS dropoff_zone
    FROM staged_trips t
    LEFT JOIN zones pu ON t.pickup_location_id = pu."LocationID"
    LEFT JOIN zones d ON t.dropoff_location_id = d."LocationID\""""

_RELATIONS = {
    "trips": (TRIPS, ()),
    "zones": (ZONES, ()),
    "weather": (WEATHER, ()),
    "bronze_trips": (BRONZE_TRIPS, ("trips",)),
    "bronze_weather": (BRONZE_WEATHER, ("weather",)),
    "silver_trips": (SILVER_TRIPS, ("bronze_trips",)),
    "silver_weather": (SILVER_WEATHER, ("bronze_weather",)),
    "staged_trips": (STAGED_TRIPS, ("silver_trips",)),
    "staged_weather": (STAGED_WEATHER, ("silver_weather",)),
    "trips_with_zones": (TRIPS_WITH_ZONES, ("staged_trips", "zones")),
}


def using(
    *names: str, then: str, also: dict[str, str] | None = None, instead: dict[str, str] | None = None
) -> str:
    """A statement over the named relations and everything they rest on; texts in
    `instead` take the place of the usual ones."""
    needed: list[str] = []

    def need(name: str) -> None:
        for parent in _RELATIONS[name][1]:
            need(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        need(name)
    texts = {name: _RELATIONS[name][0] for name in needed} | (instead or {})
    parts = [f"{name} AS MATERIALIZED ({texts[name]})" for name in needed]
    parts += [f"{name} AS MATERIALIZED ({body})" for name, body in (also or {}).items()]
    return "WITH " + ",\n".join(parts) + "\n" + then
