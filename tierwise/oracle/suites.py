"""The four suites once more, stated apart from the engine's own, so that a
wrong bound or a missing column there shows as a difference."""

from __future__ import annotations

from tierwise.operators.quality import Check

# Expectations by short name.
EXPECT = {
    "rows": "expect_table_row_count_to_be_between",
    "exists": "expect_column_to_exist",
    "filled": "expect_column_values_to_not_be_null",
    "between": "expect_column_values_to_be_between",
    "greater": "expect_column_pair_values_a_to_be_greater_than_b",
    "in_set": "expect_column_values_to_be_in_set",
    "unique_count": "expect_column_unique_value_count_to_be_between",
    "compound": "expect_compound_columns_to_be_unique",
}

# Row bounds of a batch.
ROWS = {
    "taxi/bronze": (200_000, 6_000_000),
    "taxi/silver": (180_000, 5_800_000),
    "weather/bronze": (1_000_000, 5_000_000),
    "weather/silver": (800_000, 5_000_000),
}

# Columns that have to be there.
EXISTING = {
    "taxi/bronze": """VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance RatecodeID
        store_and_fwd_flag PULocationID DOLocationID payment_type fare_amount extra mta_tax tip_amount tolls_amount
        improvement_surcharge total_amount congestion_surcharge ingested_at source_file source_year source_month""",
    "taxi/silver": """VendorID tpep_pickup_datetime tpep_dropoff_datetime passenger_count trip_distance PULocationID
        DOLocationID payment_type fare_amount tip_amount tolls_amount total_amount source_year source_month source_file
        ingested_at trip_duration_minutes pickup_day_of_week trip_speed_mph pickup_hour payment_method day_name
        is_weekend pickup_date processed_at""",
    "weather/bronze": """STATION DATE DEWP DEWP_ATTRIBUTES WDSP WDSP_ATTRIBUTES TEMP TEMP_ATTRIBUTES MXSPD MAX
        MAX_ATTRIBUTES GUST MIN MIN_ATTRIBUTES VISIB VISIB_ATTRIBUTES PRCP PRCP_ATTRIBUTES SNDP FRSHTT STP
        STP_ATTRIBUTES SLP SLP_ATTRIBUTES ingested_at source_file source_year source_month""",
    "weather/silver": """STATION DATE LATITUDE LONGITUDE ELEVATION NAME TEMP DEWP SLP STP VISIB WDSP MXSPD GUST MAX MIN
        PRCP SNDP source_year source_month source_file ingested_at season_northern is_weekend day_name temp_c
        max_temp_c min_temp_c wdsp_kmh mxspd_kmh gust_kmh is_freezing is_extreme_heat has_precipitation is_gale
        processed_at""",
}

# Columns that have to be filled, by the share of rows that is enough.
FILLED = {
    "taxi/bronze": {
        0.9: """tpep_pickup_datetime tpep_dropoff_datetime fare_amount trip_distance ingested_at source_file
            source_year source_month""",
    },
    "taxi/silver": {
        1.0: """tpep_pickup_datetime tpep_dropoff_datetime PULocationID DOLocationID fare_amount trip_distance
            passenger_count payment_type trip_duration_minutes pickup_day_of_week pickup_hour payment_method day_name
            is_weekend pickup_date source_year source_month processed_at""",
        0.75: "trip_speed_mph",
    },
    "weather/bronze": {0.9: "STATION DATE DEWP WDSP TEMP MXSPD MAX MIN VISIB PRCP source_year source_month"},
    "weather/silver": {
        1.0: """STATION DATE TEMP WDSP VISIB PRCP LATITUDE LONGITUDE source_year source_month source_file ingested_at
            season_northern day_name is_weekend is_freezing is_extreme_heat has_precipitation is_gale temp_c
            processed_at""",
        0.75: "DEWP SLP STP MXSPD GUST MAX MIN SNDP max_temp_c min_temp_c mxspd_kmh gust_kmh",
    },
}

# Least and greatest values.
RANGES = {
    "taxi/silver": {
        "fare_amount": (0, 500), "trip_distance": (0, None), "passenger_count": (1, 6),
        "trip_duration_minutes": (1, 1440), "pickup_hour": (0, 23), "pickup_day_of_week": (0, 6),
    },
    "weather/silver": {
        "LATITUDE": (-90, 90), "LONGITUDE": (-180, 180), "ELEVATION": (-500, 9000), "TEMP": (-129, 135),
        "temp_c": (-89, 57), "WDSP": (0, 200), "wdsp_kmh": (0, 370), "PRCP": (0, 30), "VISIB": (0, 999),
    },
}

# Allowed values.
MONTHS, FLAGS = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12), (True, False)
ALLOWED = {
    "taxi/silver": {
        "payment_method": ("Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Voided"),
        "day_name": ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
        "is_weekend": FLAGS, "source_month": MONTHS,
    },
    "weather/silver": {
        "season_northern": ("winter", "spring", "summer", "fall"), "is_weekend": FLAGS, "is_freezing": FLAGS,
        "is_extreme_heat": FLAGS, "has_precipitation": FLAGS, "is_gale": FLAGS, "source_month": MONTHS,
    },
}


def suite(name: str, rows: tuple[int, int] | None = None) -> list[Check]:
    low, high = rows or ROWS[name]
    checks = [Check(EXPECT["rows"], low=low, high=high)]
    checks += [Check(EXPECT["exists"], c) for c in EXISTING[name].split()]
    checks += [Check(EXPECT["filled"], c, mostly=m) for m, cs in FILLED[name].items() for c in cs.split()]
    checks += [Check(EXPECT["between"], c, low=a, high=b) for c, (a, b) in RANGES.get(name, {}).items()]
    checks += [Check(EXPECT["in_set"], c, values=v) for c, v in ALLOWED.get(name, {}).items()]
    if name == "taxi/silver":
        checks.append(Check(EXPECT["greater"], "tpep_dropoff_datetime", other="tpep_pickup_datetime"))
    if name == "weather/silver":
        checks.append(Check(EXPECT["unique_count"], "source_month", low=12, high=12))
        checks.append(Check(EXPECT["compound"], columns=("STATION", "DATE")))
    return checks
