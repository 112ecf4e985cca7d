"""The zone dimension and its joins to trips."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trips_with_zones(staged: DataFrame, zones: DataFrame) -> DataFrame:
    """Left joins on pickup and dropoff id; unmatched ids keep their trips.
    The dropoff side brings no service zone. Spark broadcasts the lookup as long
    as it is small in bytes, and sorts and splits skewed keys beyond that."""
    pickup = zones.select(
        F.col("LocationID").alias("_pickup_id"),
        F.col("Borough").alias("pickup_borough"),
        F.col("Zone").alias("pickup_zone"),
        F.col("service_zone").alias("pickup_service_zone"),
    )
    dropoff = zones.select(
        F.col("LocationID").alias("_dropoff_id"),
        F.col("Borough").alias("dropoff_borough"),
        F.col("Zone").alias("dropoff_zone"),
    )
    return (
        staged.join(pickup, F.col("pickup_location_id") == F.col("_pickup_id"), "left")
        .join(dropoff, F.col("dropoff_location_id") == F.col("_dropoff_id"), "left")
        .drop("_pickup_id", "_dropoff_id")
    )
