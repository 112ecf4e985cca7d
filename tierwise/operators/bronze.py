"""Audit columns of the Bronze layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TRIP_FILE = "concat('raw/taxi/', source_year, '-', lpad(source_month, 2, '0'), '.parquet')"
_WEATHER_FILE = "concat('raw/weather/', source_year, '.tar.gz')"
_MONTH = "CAST(month(try_cast(`DATE` AS DATE)) AS TINYINT)"


def audit_trips(df: DataFrame, ingested_at: str = "current_timestamp()") -> DataFrame:
    """Ingest time and source file of monthly batches; the batch columns are
    already there, so any number of months is audited in one pass. Rows read
    from files tell their file; others get the batch's usual name."""
    return df.withColumns({"ingested_at": F.expr(ingested_at), "source_file": _source_file(df, _TRIP_FILE)})


def audit_weather(df: DataFrame, ingested_at: str = "current_timestamp()") -> DataFrame:
    """As for trips, with a yearly source file and the month of each row."""
    return df.withColumns(
        {
            "ingested_at": F.expr(ingested_at),
            "source_file": _source_file(df, _WEATHER_FILE),
            "source_month": F.expr(_MONTH),
        }
    )


def _source_file(df: DataFrame, usual: str) -> Column:
    return F.col("source_file") if "source_file" in df.columns else F.expr(usual)
