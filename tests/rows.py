"""Hand-made rows: one good row per domain, changed one field at a time."""

from __future__ import annotations

import datetime

GOOD_TRIP = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime.datetime(2023, 1, 15, 8, 0, 0),
    "tpep_dropoff_datetime": datetime.datetime(2023, 1, 15, 8, 30, 0),
    "passenger_count": 2.0,
    "trip_distance": 5.0,
    "RatecodeID": 1,
    "store_and_fwd_flag": "N",
    "PULocationID": 10,
    "DOLocationID": 20,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 4.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 25.3,
    "congestion_surcharge": 2.5,
    "airport_fee": 0.0,
    "source_year": 2023,
    "source_month": 1,
}

TRIP_SCHEMA = (
    "VendorID BIGINT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ,"
    " passenger_count DOUBLE, trip_distance DOUBLE, RatecodeID BIGINT, store_and_fwd_flag STRING,"
    " PULocationID BIGINT, DOLocationID BIGINT, payment_type BIGINT, fare_amount DOUBLE, extra DOUBLE,"
    " mta_tax DOUBLE, tip_amount DOUBLE, tolls_amount DOUBLE, improvement_surcharge DOUBLE,"
    " total_amount DOUBLE, congestion_surcharge DOUBLE, airport_fee DOUBLE, source_year SMALLINT,"
    " source_month TINYINT"
)

GOOD_DAY = {
    "STATION": "01001099999",
    "DATE": "2023-07-04",
    "LATITUDE": "70.9",
    "LONGITUDE": "-8.6",
    "ELEVATION": "9.0",
    "NAME": "JAN MAYEN, NO",
    "TEMP": "50.0",
    "DEWP": "45.0",
    "SLP": "1010.0",
    "STP": "1009.0",
    "VISIB": "6.2",
    "WDSP": "10.0",
    "MXSPD": "15.0",
    "GUST": "999.9",
    "MAX": "55.0",
    "MIN": "44.0",
    "PRCP": "0.01",
    "SNDP": "999.9",
    "source_year": 2023,
    "source_month": 7,
}


def trips(spark, *changes):
    rows = [{**GOOD_TRIP, **c} for c in changes]
    return spark.createDataFrame([tuple(r[k] for k in GOOD_TRIP) for r in rows], TRIP_SCHEMA)


def days(spark, *changes):
    rows = [{**GOOD_DAY, **c} for c in changes]
    types = ["SMALLINT" if k == "source_year" else "TINYINT" if k == "source_month" else "STRING" for k in GOOD_DAY]
    schema = ", ".join(f"`{k}` {t}" for k, t in zip(GOOD_DAY, types))
    return spark.createDataFrame([tuple(r[k] for k in GOOD_DAY) for r in rows], schema)
