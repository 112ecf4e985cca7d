"""Column contracts of the layers: fixed names and types."""

from __future__ import annotations

# Raw trip columns, in file order, with the type every batch is
# widened to. `airport_fee` is missing from early batches.
TRIP_SOURCE = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "bigint",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# Raw station-day columns. The source is text, so every column is
# read as a string and cast by the Silver step.
WEATHER_SOURCE = (
    "STATION",
    "DATE",
    "LATITUDE",
    "LONGITUDE",
    "ELEVATION",
    "NAME",
    "TEMP",
    "TEMP_ATTRIBUTES",
    "DEWP",
    "DEWP_ATTRIBUTES",
    "SLP",
    "SLP_ATTRIBUTES",
    "STP",
    "STP_ATTRIBUTES",
    "VISIB",
    "VISIB_ATTRIBUTES",
    "WDSP",
    "WDSP_ATTRIBUTES",
    "MXSPD",
    "GUST",
    "MAX",
    "MAX_ATTRIBUTES",
    "MIN",
    "MIN_ATTRIBUTES",
    "PRCP",
    "PRCP_ATTRIBUTES",
    "SNDP",
    "FRSHTT",
)

AUDIT = ("ingested_at", "source_file", "source_year", "source_month")
PARTITION_KEYS = ("source_year", "source_month")
PARTITION_TYPES = {"source_year": "smallint", "source_month": "tinyint"}

ZONE_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
