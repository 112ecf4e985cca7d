"""Aggregate blocks shared by the Gold models, as SQL expression text.

A block maps output names to aggregate expressions. Sums are exact, and
sums, averages and ratios are rounded once, on the finished aggregate. All of them have
constant-size state and merge map-side, so a group that holds most of the rows
costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierwise.functions import average, count_where, exact_sum, ratio, round2_agg, sum2

Block = dict[str, str]


def columns(*blocks: Block) -> list[Column]:
    return [F.expr(e).alias(name) for block in blocks for name, e in block.items()]


def _avg(c: str) -> str:
    return round2_agg(average(c))


# --- trips ---------------------------------------------------------------

VOLUME = {
    "total_trips": "count(*)",
    "total_passengers": "sum(CAST(passenger_count AS BIGINT))",
}

REVENUE = {
    "total_fare_revenue": sum2("fare_amount"),
    "total_tips": sum2("tip_amount"),
    "total_tolls": sum2("tolls_amount"),
    "total_revenue": sum2("total_amount"),
}

AVERAGES = {
    "avg_fare": _avg("fare_amount"),
    "avg_tip": _avg("tip_amount"),
    "avg_trip_distance": _avg("trip_distance"),
    "avg_trip_duration_minutes": _avg("trip_duration_minutes"),
    "avg_passengers_per_trip": _avg("passenger_count"),
}

EFFICIENCY = {
    "revenue_per_mile": round2_agg(ratio(exact_sum("fare_amount"), exact_sum("trip_distance"))),
    "revenue_per_minute": round2_agg(ratio(exact_sum("fare_amount"), exact_sum("trip_duration_minutes"))),
    "tip_percentage": round2_agg(f"{ratio(exact_sum('tip_amount'), exact_sum('fare_amount'))} * 100"),
}

PAYMENT_SPLIT = {
    "credit_card_trips": count_where("payment_type = 1"),
    "cash_trips": count_where("payment_type = 2"),
    "no_charge_trips": count_where("payment_type = 3"),
}


def _peak_hours(hour: str = "pickup_hour") -> Block:
    """Lower median and most frequent hour (the earliest on a tie).

    Both come from 24 running counters, the number of trips up to each hour.
    The built-in percentile and mode keep a map per group, and Spark turns to
    sorting all rows once a task holds more than a few such groups.
    """
    up_to = [count_where(f"{hour} <= {h}") for h in range(24)]
    total = up_to[-1]
    median = " + ".join(f"CAST({up_to[h]} * 2 < {total} AS INT)" for h in range(24))
    at = [up_to[0]] + [f"({up_to[h]} - {up_to[h - 1]})" for h in range(1, 24)]
    mode = f"array_position(array({', '.join(at)}), greatest({', '.join(at)})) - 1"
    return {
        "peak_pickup_hour": f"CASE WHEN {total} > 0 THEN CAST({median} AS SMALLINT) END",
        "modal_pickup_hour": f"CASE WHEN {total} > 0 THEN CAST({mode} AS SMALLINT) END",
    }


PEAK_HOURS = _peak_hours()


def pick(*names: str) -> Block:
    """Single metrics out of the trip blocks."""
    known = {**VOLUME, **REVENUE, **AVERAGES}
    return {name: known[name] for name in names}


# --- station days --------------------------------------------------------


def _extreme(function: str, c: str) -> str:
    return round2_agg(f"{function}(CAST({c} AS DOUBLE))")


def _share(flag: str) -> str:
    return round2_agg(f"CAST({count_where(flag)} AS DOUBLE) * 100 / nullif(CAST(count(*) AS DOUBLE), 0D)")


def temperature(low: str, high: str) -> Block:
    return {
        "avg_temp_f": _avg("temp_f"),
        f"{low}_f": _extreme("min", "temp_f"),
        f"{high}_f": _extreme("max", "temp_f"),
        "temp_stddev_f": round2_agg("stddev(CAST(temp_f AS DOUBLE))"),
        "avg_temp_c": _avg("temp_c"),
        f"{low}_c": _extreme("min", "temp_c"),
        f"{high}_c": _extreme("max", "temp_c"),
    }


def precipitation(days: str) -> Block:
    return {
        "total_precipitation_in": sum2("prcp_in"),
        "avg_daily_precipitation_in": _avg("prcp_in"),
        days: count_where("has_precipitation"),
        "precipitation_frequency_pct": _share("has_precipitation"),
    }


def max_gust(name: str) -> Block:
    return {name: _extreme("max", "gust_kts")}


def span(years: str) -> Block:
    return {
        "total_observations": "count(*)",
        "first_observation": "min(date)",
        "last_observation": "max(date)",
        "years_of_data": years,
    }


WIND_AVERAGE = {
    "avg_wind_speed_kts": _avg("wdsp_kts"),
    "avg_wind_speed_kmh": _avg("wdsp_kmh"),
}
MAX_WIND = {"max_wind_speed_kts": _extreme("max", "mxspd_kts")}
GALE = {"gale_days": count_where("is_gale")}
TEMPERATURE_EVENTS = {
    "freezing_days": count_where("is_freezing"),
    "freezing_frequency_pct": _share("is_freezing"),
    "extreme_heat_days": count_where("is_extreme_heat"),
    "extreme_heat_frequency_pct": _share("is_extreme_heat"),
}
SNOW = {
    "snow_days": count_where("sndp_in > 0"),
    "avg_snow_depth_in": _avg("CASE WHEN sndp_in > 0 THEN sndp_in END"),
}
MAX_SNOW = {"max_snow_depth_in": _extreme("max", "sndp_in")}
VISIBILITY = {"avg_visibility_mi": _avg("visib_mi")}
MIN_VISIBILITY = {"min_visibility_mi": _extreme("min", "visib_mi")}
