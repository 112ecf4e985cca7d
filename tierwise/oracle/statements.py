"""Oracle statements of the batch, cleaning, Gold and dashboard queries."""

from __future__ import annotations

from tierwise.oracle.relations import TRIP_RULES, WEATHER_RULES, using


def _agg2(expression: str) -> str:
    """Two decimals, after removing what the order of division leaves behind."""
    return f"round(round({expression}, 7), 2)"


def _exact(x: str) -> str:
    return f"sum(CAST(CAST({x} AS DOUBLE) AS DECIMAL(38, 8)))"


def _sum2(x: str) -> str:
    return f"CAST(round({_exact(x)}, 2) AS DOUBLE)"


def _share2(top: str, below: str, times: str = "") -> str:
    return _agg2(f"CAST({top} AS DOUBLE) / nullif(CAST({below} AS DOUBLE), 0){times}")


def _avg2(x: str) -> str:
    return _share2(_exact(x), f"count({x})")


_TRIP_BASE = f"""
    count(*) AS total_trips,
    CAST(sum(passenger_count) AS BIGINT) AS total_passengers,
    {_sum2("fare_amount")} AS total_fare_revenue,
    {_sum2("tip_amount")} AS total_tips,
    {_sum2("tolls_amount")} AS total_tolls,
    {_sum2("total_amount")} AS total_revenue,
    {_avg2("fare_amount")} AS avg_fare,
    {_avg2("tip_amount")} AS avg_tip,
    {_avg2("trip_distance")} AS avg_trip_distance,
    {_avg2("trip_duration_minutes")} AS avg_trip_duration_minutes,
    {_avg2("passenger_count")} AS avg_passengers_per_trip,
    {_share2(_exact("fare_amount"), _exact("trip_distance"))}
        AS revenue_per_mile,
    {_share2(_exact("fare_amount"), _exact("trip_duration_minutes"))}
        AS revenue_per_minute,
    {_share2(_exact("tip_amount"), _exact("fare_amount"), " * 100")} AS tip_percentage"""

_PAYMENTS = """
    count(*) FILTER (WHERE payment_type = 1) AS credit_card_trips,
    count(*) FILTER (WHERE payment_type = 2) AS cash_trips,
    count(*) FILTER (WHERE payment_type = 3) AS no_charge_trips"""

_TRIP_KEYS = {
    "daily_summary": ("pickup_day_of_week", "day_name", "source_year", "source_month"),
    "hourly_summary": ("pickup_hour", "source_year", "source_month"),
    "individual_day_summary": (
        "pickup_date", "source_year", "source_month", "pickup_day_of_week", "is_weekend", "day_name",
    ),
    "payment_summary": ("payment_type", "payment_method", "source_year", "source_month"),
    "zone_performance": (
        "pickup_borough", "pickup_zone", "pickup_service_zone", "dropoff_borough", "dropoff_zone",
        "source_year", "source_month",
    ),
}


def trip_model(name: str, peak: bool = True, payments: bool = True) -> tuple[str, dict[str, str]]:
    """Text of one trip model, and the helper relation it needs."""
    keys = _TRIP_KEYS[name]
    columns = ", ".join(keys)
    if not peak:
        body = f"SELECT {columns},{_TRIP_BASE}, {_PAYMENTS}\nFROM trips_with_zones GROUP BY {columns}"
        return body, {}
    on = " AND ".join(f"g.{k} IS NOT DISTINCT FROM h.{k}" for k in keys)
    per_hour = (
        f"SELECT {columns}, pickup_hour AS hour_of_day, row_number() OVER (PARTITION BY {columns} "
        f"ORDER BY count(*) DESC, pickup_hour) AS place FROM trips_with_zones "
        f"GROUP BY {', '.join(dict.fromkeys((*keys, 'pickup_hour')))}"
    )
    metrics = _TRIP_BASE + ", percentile_disc(0.5) WITHIN GROUP (ORDER BY pickup_hour) AS peak_pickup_hour"
    if payments:
        metrics += "," + _PAYMENTS
    grouped = f"SELECT {columns},{metrics}\nFROM trips_with_zones GROUP BY {columns}"
    body = (
        f"SELECT g.*, h.hour_of_day AS modal_pickup_hour FROM {name}_groups g "
        f"JOIN {name}_hours h ON h.place = 1 AND {on}"
    )
    return body, {f"{name}_groups": grouped, f"{name}_hours": per_hour}


def _trip_gold(name: str, **options: bool) -> str:
    body, also = trip_model(name, **options)
    return using("trips_with_zones", then=body, also=also)


_ALL_KEYS = sorted({k for keys in _TRIP_KEYS.values() for k in keys})
# The metrics of the trip models.
_METRICS = (
    "total_trips", "total_passengers", "total_fare_revenue", "total_tips", "total_tolls", "total_revenue",
    "avg_fare", "avg_tip", "avg_trip_distance", "avg_trip_duration_minutes", "avg_passengers_per_trip",
    "revenue_per_mile", "revenue_per_minute", "tip_percentage",
    "peak_pickup_hour", "modal_pickup_hour", "credit_card_trips", "cash_trips", "no_charge_trips",
)


def _one_pass() -> str:
    also: dict[str, str] = {}
    parts = []
    for name, keys in _TRIP_KEYS.items():
        # Every model gets all metrics there, also those it does not store.
        body, helpers = trip_model(name, peak=True, payments=True)
        also.update(helpers)
        columns = [k if k in keys else f"NULL AS {k}" for k in _ALL_KEYS]
        parts.append(f"SELECT '{name}' AS model, {', '.join([*columns, *_METRICS])} FROM ({body}) m")
    return using("trips_with_zones", then="\nUNION ALL\n".join(parts), also=also)


def _temperature(low: str, high: str) -> str:
    return f"""
    {_avg2("temp_f")} AS avg_temp_f,
    round(min(CAST(temp_f AS DOUBLE)), 2) AS {low}_f,
    round(max(CAST(temp_f AS DOUBLE)), 2) AS {high}_f,
    {_agg2("stddev(CAST(temp_f AS DOUBLE))")} AS temp_stddev_f,
    {_avg2("temp_c")} AS avg_temp_c,
    round(min(temp_c), 2) AS {low}_c,
    round(max(temp_c), 2) AS {high}_c"""


def _event(flag: str, days: str, share: str | None = None) -> str:
    text = f"count(*) FILTER (WHERE {flag}) AS {days}"
    if share:
        text += (
            f", round(CAST(count(*) FILTER (WHERE {flag}) AS DOUBLE) * 100"
            f" / nullif(CAST(count(*) AS DOUBLE), 0), 2) AS {share}"
        )
    return text


def _precipitation(days: str) -> str:
    return f"""
    {_sum2("prcp_in")} AS total_precipitation_in,
    {_avg2("prcp_in")} AS avg_daily_precipitation_in,
    {_event("has_precipitation", days, "precipitation_frequency_pct")}"""


_WEATHER_COMMON = f"""
    {_avg2("wdsp_kts")} AS avg_wind_speed_kts,
    {_avg2("wdsp_kmh")} AS avg_wind_speed_kmh,
    {_event("is_gale", "gale_days")},
    {_event("is_freezing", "freezing_days", "freezing_frequency_pct")},
    {_event("is_extreme_heat", "extreme_heat_days", "extreme_heat_frequency_pct")},
    count(*) FILTER (WHERE sndp_in > 0) AS snow_days,
    {_avg2("CASE WHEN sndp_in > 0 THEN sndp_in END")} AS avg_snow_depth_in,
    {_avg2("visib_mi")} AS avg_visibility_mi"""

_STATION = "station, station_name, latitude, longitude, elevation"

DAILY_CLIMATE = f"""
SELECT {_STATION}, date, source_year, source_month, day_name, is_weekend, season_northern,
    temp_f, temp_c, max_temp_f, max_temp_c, min_temp_f, min_temp_c, prcp_in, has_precipitation, sndp_in,
    wdsp_kts, wdsp_kmh, mxspd_kts, mxspd_kmh, gust_kts, gust_kmh, is_freezing, is_extreme_heat, is_gale,
    visib_mi
FROM staged_weather"""

MONTHLY_CLIMATE = f"""
SELECT {_STATION}, source_year, source_month, season_northern, count(*) AS observation_days,
    {_temperature("min_temp", "max_temp")},
    {_precipitation("days_with_precipitation")},
    {_WEATHER_COMMON},
    round(max(CAST(mxspd_kts AS DOUBLE)), 2) AS max_wind_speed_kts,
    round(max(CAST(gust_kts AS DOUBLE)), 2) AS max_gust_kts,
    round(max(CAST(sndp_in AS DOUBLE)), 2) AS max_snow_depth_in,
    round(min(CAST(visib_mi AS DOUBLE)), 2) AS min_visibility_mi
FROM staged_weather GROUP BY {_STATION}, source_year, source_month, season_northern"""


def _station(keys: str) -> str:
    return f"""
SELECT {keys}, count(*) AS total_observations, min(date) AS first_observation,
    max(date) AS last_observation, count(DISTINCT source_year) AS years_of_data,
    {_temperature("record_low_temp", "record_high_temp")},
    {_precipitation("precipitation_days")},
    {_WEATHER_COMMON},
    round(max(CAST(gust_kts AS DOUBLE)), 2) AS max_gust_recorded_kts
FROM staged_weather GROUP BY {keys}"""


STATION_METRICS = _station(_STATION + ", source_year, source_month")


def _drop_report(source: str, rules: dict[str, str]) -> str:
    kept = " AND ".join(f"({c})" for c in rules.values())
    failed = ",\n    ".join(
        f"count(*) FILTER (WHERE coalesce({c}, FALSE) = FALSE) AS failed_{name}"
        for name, c in rules.items()
    )
    return f"""
SELECT source_year, source_month, count(*) AS rows_read,
    count(*) FILTER (WHERE {kept}) AS rows_kept,
    count(*) - count(*) FILTER (WHERE {kept}) AS rows_dropped,
    {failed}
FROM {source} GROUP BY source_year, source_month"""


# Columns that cleaning adds to trips, with their Spark types.
_ADDED = {
    "trip_duration_minutes": "bigint",
    "pickup_day_of_week": "smallint",
    "trip_speed_mph": "float",
    "pickup_hour": "smallint",
    "payment_method": "string",
    "day_name": "string",
    "is_weekend": "boolean",
    "pickup_date": "date",
    "processed_at": "timestamp",
}
_ENRICHED = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS name, '{kind}' AS type, count({name}) AS filled"
    " FROM (SELECT *, now() AS processed_at FROM silver_trips) s"
    for name, kind in _ADDED.items()
)

_TRIP_GAPS = ", ".join(
    f'CASE WHEN "PULocationID" = {pu} AND "DOLocationID" = {do} THEN NULL ELSE "{c}" END AS "{c}"'
    for c, pu, do in (
        ("tpep_pickup_datetime", 3, 4), ("tpep_dropoff_datetime", 5, 6), ("PULocationID", 7, 8),
        ("DOLocationID", 9, 10), ("fare_amount", 11, 12), ("trip_distance", 13, 14), ("payment_type", 15, 16),
    )
)
_DAY_GAPS = ", ".join(
    f"""CASE WHEN "STATION" = '{station}' AND source_month = {month} THEN NULL ELSE "{c}" END AS "{c}\""""
    for c, station, month in (
        ("TEMP", "S003", 3), ("WDSP", "S004", 4), ("VISIB", "S005", 5), ("PRCP", "S006", 6),
        ("LATITUDE", "S007", 7), ("LONGITUDE", "S008", 8), ("STATION", "S009", 9),
    )
)
_DATE_GAPS = """CASE WHEN "STATION" = 'S010' AND source_month = 10 THEN NULL
    WHEN "STATION" = 'S001' AND source_month = 1 THEN DATE '2999-01-01'
    WHEN "STATION" = 'S002' AND source_month = 2 THEN CAST("DATE" + INTERVAL 12 MONTH AS DATE)
    ELSE "DATE" END AS "DATE\""""


def statements() -> dict[str, str]:
    whole = {
        "bronze_trips": ("bronze_trips", "SELECT * FROM bronze_trips"),
        "bronze_weather": ("bronze_weather", "SELECT * FROM bronze_weather"),
        "silver_trips": ("silver_trips", "SELECT * FROM silver_trips"),
        "silver_weather": ("silver_weather", "SELECT * FROM silver_weather"),
        "stg_trips": ("staged_trips", "SELECT * FROM staged_trips"),
        "stg_weather": ("staged_weather", "SELECT * FROM staged_weather"),
        "zone_lookup": ("zones", "SELECT * FROM zones"),
        "trips_with_zones": ("trips_with_zones", "SELECT * FROM trips_with_zones"),
        "enriched_columns": ("silver_trips", _ENRICHED),
        "drop_report": ("bronze_trips", _drop_report("bronze_trips", TRIP_RULES)),
        "drop_report_weather": ("bronze_weather", _drop_report("bronze_weather", WEATHER_RULES)),
        "drop_report_gaps": (
            "trips",
            _drop_report(f"(SELECT * REPLACE ({_TRIP_GAPS}) FROM trips) t", TRIP_RULES),
        ),
        "drop_report_weather_gaps": (
            "weather",
            _drop_report(f"(SELECT * REPLACE ({_DAY_GAPS}, {_DATE_GAPS}) FROM weather) w", WEATHER_RULES),
        ),
        "gold_daily_climate": ("staged_weather", DAILY_CLIMATE),
        "gold_monthly_climate": ("staged_weather", MONTHLY_CLIMATE),
        "gold_station_metrics": (
            "staged_weather",
            STATION_METRICS,
        ),
        "gold_station_longterm": ("staged_weather", _station(_STATION)),
        "dash_revenue_by_year": (
            "staged_trips",
            f"""
SELECT source_year, count(*) AS total_trips, {_sum2("total_amount")} AS total_revenue,
    {_sum2("fare_amount")} AS total_fare_revenue,
    {_sum2("tip_amount")} AS total_tips
FROM staged_trips GROUP BY source_year""",
        ),
        "dash_fare_trend": (
            "staged_trips",
            f"""
SELECT source_year, source_month, count(*) AS total_trips,
    {_avg2("fare_amount")} AS avg_fare,
    {_avg2("trip_distance")} AS avg_trip_distance
FROM staged_trips GROUP BY source_year, source_month""",
        ),
        "dash_zone_hour": (
            "trips_with_zones",
            f"""
SELECT pickup_borough, pickup_zone, pickup_hour, count(*) AS total_trips,
    {_sum2("total_amount")} AS total_revenue
FROM trips_with_zones GROUP BY pickup_borough, pickup_zone, pickup_hour""",
        ),
        "dash_weather_trend": (
            "staged_weather",
            f"""
SELECT source_year, source_month, count(*) AS observations,
    {_avg2("temp_c")} AS avg_temp_c, {_sum2("prcp_in")} AS total_precipitation_in,
    {_avg2("wdsp_kmh")} AS avg_wind_speed_kmh,
    count(*) FILTER (WHERE is_freezing) AS freezing_days,
    count(*) FILTER (WHERE is_extreme_heat) AS extreme_heat_days,
    count(*) FILTER (WHERE has_precipitation) AS precipitation_days,
    count(*) FILTER (WHERE is_gale) AS gale_days
FROM staged_weather GROUP BY source_year, source_month""",
        ),
    }
    out = {key: using(relation, then=text) for key, (relation, text) in whole.items()}
    out["gold_weekday_summary"] = _trip_gold("daily_summary")
    out["gold_hourly_summary"] = _trip_gold("hourly_summary", peak=False)
    out["gold_date_summary"] = _trip_gold("individual_day_summary")
    out["gold_payment_summary"] = _trip_gold("payment_summary", payments=False)
    out["gold_zone_performance"] = _trip_gold("zone_performance")
    out["gold_trips_one_pass"] = _one_pass()
    return out
