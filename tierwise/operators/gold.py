"""The Gold models: eight aggregate tables and how each is written and sorted."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwise.operators import metrics as m


@dataclass(frozen=True)
class TripModel:
    """One grouping of the enriched trips."""

    name: str
    keys: tuple[str, ...]
    blocks: tuple[m.Block, ...]
    order: tuple[str, ...]

    def build(self, trips: DataFrame) -> DataFrame:
        return trips.groupBy(*self.keys).agg(*m.columns(*self.blocks))


_BASE = (m.VOLUME, m.REVENUE, m.AVERAGES, m.EFFICIENCY)

TRIP_MODELS = {
    model.name: model
    for model in (
        TripModel(
            "daily_summary",
            ("pickup_day_of_week", "day_name", "source_year", "source_month"),
            (*_BASE, m.PEAK_HOURS, m.PAYMENT_SPLIT),
            ("pickup_day_of_week",),
        ),
        TripModel(
            "hourly_summary",
            ("pickup_hour", "source_year", "source_month"),
            (*_BASE, m.PAYMENT_SPLIT),
            ("pickup_hour",),
        ),
        TripModel(
            "individual_day_summary",
            (
                "pickup_date",
                "source_year",
                "source_month",
                "pickup_day_of_week",
                "is_weekend",
                "day_name",
            ),
            (*_BASE, m.PEAK_HOURS, m.PAYMENT_SPLIT),
            ("pickup_date",),
        ),
        TripModel(
            "payment_summary",
            ("payment_type", "payment_method", "source_year", "source_month"),
            (*_BASE, m.PEAK_HOURS),
            ("payment_type",),
        ),
        TripModel(
            "zone_performance",
            (
                "pickup_borough",
                "pickup_zone",
                "pickup_service_zone",
                "dropoff_borough",
                "dropoff_zone",
                "source_year",
                "source_month",
            ),
            (*_BASE, m.PEAK_HOURS, m.PAYMENT_SPLIT),
            ("-total_trips",),
        ),
    )
}

_STATION = ("station", "station_name", "latitude", "longitude", "elevation")


def daily_climate(staged: DataFrame) -> DataFrame:
    """Station days as they are, without the pressure and dew-point columns."""
    return staged.select(
        *_STATION,
        "date",
        "source_year",
        "source_month",
        "day_name",
        "is_weekend",
        "season_northern",
        "temp_f",
        "temp_c",
        "max_temp_f",
        "max_temp_c",
        "min_temp_f",
        "min_temp_c",
        "prcp_in",
        "has_precipitation",
        "sndp_in",
        "wdsp_kts",
        "wdsp_kmh",
        "mxspd_kts",
        "mxspd_kmh",
        "gust_kts",
        "gust_kmh",
        "is_freezing",
        "is_extreme_heat",
        "is_gale",
        "visib_mi",
        "processed_at",
    )


def monthly_climate(staged: DataFrame) -> DataFrame:
    keys = (*_STATION, "source_year", "source_month", "season_northern")
    return staged.groupBy(*keys).agg(
        *m.columns(
            {"observation_days": "count(*)"},
            m.temperature("min_temp", "max_temp"),
            m.precipitation("days_with_precipitation"),
            m.WIND_AVERAGE,
            m.MAX_WIND,
            m.max_gust("max_gust_kts"),
            m.GALE,
            m.TEMPERATURE_EVENTS,
            m.SNOW,
            m.MAX_SNOW,
            m.VISIBILITY,
            m.MIN_VISIBILITY,
        )
    )


def _station_columns(years: str) -> list[Column]:
    return m.columns(
        m.span(years),
        m.temperature("record_low_temp", "record_high_temp"),
        m.precipitation("precipitation_days"),
        m.WIND_AVERAGE,
        m.max_gust("max_gust_recorded_kts"),
        m.TEMPERATURE_EVENTS,
        m.SNOW,
        m.VISIBILITY,
        m.GALE,
    )


def station_metrics(staged: DataFrame) -> DataFrame:
    """Station statistics per month. The year is a grouping key, so a group has
    one distinct year (none if it is null) and needs no distinct count."""
    years = "CAST(count(source_year) > 0 AS BIGINT)"
    return staged.groupBy(*_STATION, "source_year", "source_month").agg(*_station_columns(years))


def station_longterm(staged: DataFrame) -> DataFrame:
    """The same statistics over all years of a station."""
    return staged.groupBy(*_STATION).agg(*_station_columns("count(DISTINCT source_year)"))


WEATHER_MODELS = {
    "daily_climate": daily_climate,
    "monthly_climate": monthly_climate,
    "station_metrics": station_metrics,
}

# Sort keys of every model; a leading minus sorts downwards.
ORDER = {
    **{name: model.order for name, model in TRIP_MODELS.items()},
    "daily_climate": ("station", "date"),
    "monthly_climate": ("station", "source_year", "source_month"),
    "station_metrics": ("-total_observations",),
    "station_longterm": ("-total_observations",),
}


def sort_columns(model: str) -> list[Column]:
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in ORDER[model]]


def ordered(model: str, df: DataFrame) -> DataFrame:
    """A model's result in reading order."""
    return df.orderBy(*sort_columns(model))


def trip_models_in_one_pass(trips: DataFrame) -> DataFrame:
    """All five trip models from a single scan and a single shuffle.

    Rows carry `model` and the columns of all models, null where a model lacks
    them. Reading the trips once matters more than the five-fold expansion,
    which stays in memory and is aggregated before it is shuffled.
    """
    keys = sorted({k for model in TRIP_MODELS.values() for k in model.keys})
    sets = [[F.col(k) for k in model.keys] for model in TRIP_MODELS.values()]
    # The grouping id has a bit per key, set where the model lacks the key.
    ids = {
        sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in model.keys): name
        for name, model in TRIP_MODELS.items()
    }
    cases = " ".join(f"WHEN {bits} THEN '{name}'" for bits, name in ids.items())
    return trips.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.expr(f"CASE grouping_id() {cases} END").alias("model"),
        *m.columns(*_BASE, m.PEAK_HOURS, m.PAYMENT_SPLIT),
    )


def pick_trip_model(combined: DataFrame, name: str) -> DataFrame:
    """One model's rows and columns out of the combined result."""
    model = TRIP_MODELS[name]
    return combined.where(F.col("model") == name).select(
        *model.keys, *[c for block in model.blocks for c in block]
    )
