from __future__ import annotations

import datetime

import pytest

from tests.rows import days, trips
from tierwise.operators.bronze import audit_trips, audit_weather
from tierwise.operators.rules import TRIP_REQUIRED, WEATHER_REQUIRED, drop_report, trip_rules, weather_rules
from tierwise.operators.silver import silver_trips, silver_weather

TODAY = "DATE'2023-12-31'"


def at(*parts):
    return datetime.datetime(*parts)


START = at(2023, 1, 15, 8, 0, 0)
TRIP_FAILURES = {
    **{f"null {c}": ("required", {c: None}) for c in TRIP_REQUIRED},
    "fare 0": ("fare", {"fare_amount": 0.0}),
    "fare 500": ("fare", {"fare_amount": 500.0}),
    "distance": ("distance", {"trip_distance": -0.1}),
    "no passengers": ("passengers", {"passenger_count": 0.0}),
    "7 passengers": ("passengers", {"passenger_count": 7.0}),
    "no duration": ("time_order", {"tpep_dropoff_datetime": START}),
    "same minute": ("duration", {"tpep_dropoff_datetime": at(2023, 1, 15, 8, 0, 59)}),
    "1441 minutes": ("duration", {"tpep_dropoff_datetime": at(2023, 1, 16, 8, 1, 0)}),
    "other month": ("batch", {"source_month": 2}),
    "other year": ("batch", {"source_year": 2022}),
}
TRIP_KEPT = [
    {},
    {"fare_amount": 499.99},
    {"trip_distance": 0.0},
    {"passenger_count": 1.0},
    {"passenger_count": 6.0},
    {
        "tpep_pickup_datetime": at(2023, 1, 15, 8, 0, 59),
        "tpep_dropoff_datetime": at(2023, 1, 15, 8, 1, 0),
    },
    {"tpep_dropoff_datetime": at(2023, 1, 16, 8, 0, 0)},
    {"payment_type": 9},
]


@pytest.mark.parametrize("label", TRIP_FAILURES)
def test_trip_rule(spark, label):
    rule, change = TRIP_FAILURES[label]
    bronze = trips(spark, change)
    report = drop_report(bronze, trip_rules()).first().asDict()
    assert report["rows_dropped"] == 1 and report[f"failed_{rule}"] == 1
    assert silver_trips(audit_trips(bronze)).count() == 0


def test_trips_kept(spark):
    bronze = trips(spark, *TRIP_KEPT)
    assert silver_trips(audit_trips(bronze)).count() == len(TRIP_KEPT)
    report = drop_report(bronze, trip_rules()).first()
    assert (report.rows_read, report.rows_kept, report.rows_dropped) == (8, 8, 0)


def test_trip_columns(spark):
    row = silver_trips(audit_trips(trips(spark, {"payment_type": 4}))).first()
    assert (row.trip_duration_minutes, row.trip_speed_mph, row.pickup_hour) == (30, 10.0, 8)
    assert (row.payment_method, row.day_name, row.is_weekend) == ("Dispute", "Sunday", True)
    assert row.pickup_day_of_week == 0 and row.pickup_date == datetime.date(2023, 1, 15)
    assert row.source_file == "raw/taxi/2023-01.parquet"


@pytest.mark.parametrize("code", [0, 7, 9])
def test_unknown_payment_code_has_no_name(spark, code):
    assert silver_trips(audit_trips(trips(spark, {"payment_type": code}))).first().payment_method is None


JANUARY = {"DATE": "2023-01-04", "source_month": 1}
DAY_FAILURES = {
    **{f"null {c}": ("required", {c: None}) for c in WEATHER_REQUIRED},
    "TEMP marker": ("sentinel", {"TEMP": "9999.9"}),
    "WDSP marker": ("sentinel", {"WDSP": "999.9"}),
    "PRCP marker": ("sentinel", {"PRCP": "99.99"}),
    "VISIB marker": ("sentinel", {"VISIB": "999.9"}),
    "snow marker in January": ("winter_snow", {**JANUARY, "SNDP": "999.9"}),
    "no snow depth in January": ("winter_snow", {**JANUARY, "SNDP": None}),
    "latitude": ("position", {"LATITUDE": "90.1"}),
    "longitude": ("position", {"LONGITUDE": "-180.5"}),
    "elevation": ("position", {"ELEVATION": "9000.5"}),
    "no elevation": ("position", {"ELEVATION": None}),
    "cold": ("plausible", {"TEMP": "-129.5", "MIN": None, "DEWP": None}),
    "wind": ("plausible", {"WDSP": "200.1"}),
    "rain": ("plausible", {"PRCP": "6.01"}),
    "sight": ("plausible", {"VISIB": "-1"}),
    "dew point": ("consistent", {"DEWP": "50.1"}),
    "dew point marker": ("consistent", {"DEWP": "9999.9"}),
    "min above max": ("consistent", {"MIN": "56.0"}),
    "outside min and max": ("consistent", {"TEMP": "43.0", "DEWP": None}),
    "tomorrow": ("not_future", {"DATE": "2024-01-01", "source_year": 2024, "source_month": 1, "SNDP": "0"}),
    "other year": ("batch", {"source_year": 2022}),
    "not a number": ("sentinel", {"TEMP": "abc"}),
}
DAY_KEPT = [
    {},
    {**JANUARY, "SNDP": "3.0"},
    {"SNDP": None},
    {"LATITUDE": "-90", "LONGITUDE": "180", "ELEVATION": "9000"},
    {"DEWP": None},
    {"DEWP": "50.0"},
    {"MIN": None},
    {"MAX": None},
    {"TEMP": "135", "MAX": "135", "PRCP": "6", "WDSP": "200"},
]


@pytest.mark.parametrize("label", DAY_FAILURES)
def test_weather_rule(spark, label):
    rule, change = DAY_FAILURES[label]
    report = drop_report(days(spark, change), weather_rules(TODAY)).first().asDict()
    assert report["rows_dropped"] == 1 and report[f"failed_{rule}"] == 1


def test_days_kept(spark):
    assert silver_weather(audit_weather(days(spark, *DAY_KEPT)), today=TODAY).count() == len(DAY_KEPT)


def test_weather_columns(spark):
    bronze = audit_weather(days(spark, {"TEMP": "32", "DEWP": "30", "MIN": "14", "ELEVATION": "2.5", "WDSP": "34"}))
    row = silver_weather(bronze, today=TODAY).first()
    assert (row.temp_c, row.min_temp_c, row.wdsp_kmh) == (0.0, -10.0, 62.97)
    assert (row.is_freezing, row.is_extreme_heat, row.has_precipitation, row.is_gale) == (True, False, True, True)
    assert (row.season_northern, row.day_name, row.is_weekend) == ("summer", "Tuesday", False)
    assert row.ELEVATION == 2 and row.source_month == 7


def test_seasons_and_weekends(spark):
    dates = [f"2023-{m:02d}-01" for m in range(1, 13)]
    rows = days(spark, *[{"DATE": d, "SNDP": "0"} for d in dates])
    silver = silver_weather(audit_weather(rows), today=TODAY).orderBy("DATE").collect()
    assert [r.season_northern for r in silver] == (
        ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["fall"] * 3 + ["winter"]
    )
    assert [r.is_weekend for r in silver] == [r.day_name in ("Saturday", "Sunday") for r in silver]


def test_strict_sentinels(spark):
    rows = audit_weather(days(spark, {"DEWP": "9999.9", "SNDP": "999.9", "GUST": "999.9"}))
    assert silver_weather(rows, today=TODAY).count() == 0
    row = silver_weather(rows, today=TODAY, strict_sentinels=True).first()
    assert row.DEWP is None and row.SNDP is None and row.gust_kmh is None


def test_batches_together_equal_batches_alone(spark):
    both = trips(spark, {}, {"source_month": 2}, {"fare_amount": 0.0}, {"payment_type": 2})
    whole = silver_trips(audit_trips(both)).drop("processed_at", "ingested_at")
    alone = [
        silver_trips(audit_trips(both.where(f"source_month = {m}"))).drop("processed_at", "ingested_at")
        for m in (1, 2)
    ]
    assert sorted(map(str, whole.collect())) == sorted(map(str, alone[0].unionAll(alone[1]).collect()))


def test_drops_are_counted_while_rows_are_read(spark):
    """The totals of the drop report from the pass that writes the kept rows."""
    from tierwise.operators.rules import drop_report, keep, observed, trip_rules

    rows = trips(spark, {}, {"fare_amount": -1.0}, {"fare_amount": None, "passenger_count": None}, {"trip_distance": -5.0})
    seen_rows, seen = observed(rows, trip_rules())
    assert seen_rows.columns == rows.columns
    assert keep(seen_rows, trip_rules()).count() == 1
    expected = drop_report(rows, trip_rules()).drop("source_year", "source_month").groupBy().sum().first().asDict()
    assert seen.get == {k[4:-1]: v for k, v in expected.items()}
