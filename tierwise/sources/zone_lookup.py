"""The zone lookup as a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.schemas import ZONE_SCHEMA


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Ids and names by the given schema. `N/A` and `Unknown` are ordinary
    names there, so no text is taken for a null."""
    return (
        spark.read.schema(ZONE_SCHEMA)
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("nullValue", "\u0000")
        .option("emptyValue", "")
        .csv(path)
    )


def write_zones(zones: DataFrame, path: str) -> None:
    zones.write.option("header", "true").option("quoteAll", "true").csv(path)
