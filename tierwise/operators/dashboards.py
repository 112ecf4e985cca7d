"""Data behind the dashboards: small aggregates over staged rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tierwise.operators import metrics as m


def revenue_by_year(staged_trips: DataFrame) -> DataFrame:
    return staged_trips.groupBy("source_year").agg(
        *m.columns(m.pick("total_trips", "total_revenue", "total_fare_revenue", "total_tips"))
    )


def fare_trend(staged_trips: DataFrame) -> DataFrame:
    return staged_trips.groupBy("source_year", "source_month").agg(
        *m.columns(m.pick("total_trips", "avg_fare", "avg_trip_distance"))
    )


def zone_hour(trips_with_zones: DataFrame) -> DataFrame:
    return trips_with_zones.groupBy("pickup_borough", "pickup_zone", "pickup_hour").agg(
        *m.columns(m.pick("total_trips", "total_revenue"))
    )


def weather_trend(staged_weather: DataFrame) -> DataFrame:
    temperature = m.temperature("min_temp", "max_temp")
    rain = m.precipitation("precipitation_days")
    return staged_weather.groupBy("source_year", "source_month").agg(
        *m.columns(
            {"observations": "count(*)", "avg_temp_c": temperature["avg_temp_c"]},
            {k: rain[k] for k in ("total_precipitation_in", "precipitation_days")},
            {"avg_wind_speed_kmh": m.WIND_AVERAGE["avg_wind_speed_kmh"]},
            {k: m.TEMPERATURE_EVENTS[k] for k in ("freezing_days", "extreme_heat_days")},
            m.GALE,
        )
    )
