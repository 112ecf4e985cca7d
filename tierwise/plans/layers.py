"""The layers as lazy plans over the star-schema tables, all batches at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.operators.bronze import audit_trips, audit_weather
from tierwise.operators.dimension import trips_with_zones
from tierwise.operators.silver import silver_trips, silver_weather, stage_trips, stage_weather
from tierwise.sources import tables


def bronze_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_trips(tables.trips(spark, sf_dir))


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_weather(tables.weather(spark, sf_dir))


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_trips(bronze_trips(spark, sf_dir))


def clean_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_weather(bronze_weather(spark, sf_dir))


def staged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_trips(clean_trips(spark, sf_dir))


def staged_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_weather(clean_weather(spark, sf_dir))


def zoned_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_with_zones(staged_trips(spark, sf_dir), tables.zones(spark, sf_dir))
