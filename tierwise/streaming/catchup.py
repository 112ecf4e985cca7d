"""Scheduled catch-up: ingest the batches that are new since last time.

A file stream remembers which files it has seen. Every run takes what has
landed since the previous one, works out the batches concerned, and replaces
those batches in the Bronze table from all of their files, so that a batch whose
files arrive in two runs still ends up complete. A commit names the stream, by its
checkpoint, and the stream's batch: a step that is run again because the stream
failed after the commit finds it there, and makes no second version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.operators.bronze import audit_trips, audit_weather
from tierwise.operators.versions import VersionedTable
from tierwise.sources.month_files import landed_in, read_months
from tierwise.sources.station_files import listed_archives, read_archives, with_year

_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _take_new_files(
    spark: SparkSession,
    root: str,
    pattern: str,
    checkpoint: str,
    ingest: Callable[[DataFrame, tuple[str, int]], None],
) -> None:
    """Hand the paths of files not seen before to `ingest`, with the stream and its
    batch, then stop. Only names are read; a failed `ingest` is given the same files
    and the same batch again."""
    stream = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
    )
    query = (
        stream.writeStream.foreachBatch(lambda files, batch: ingest(files, (checkpoint, batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def catch_up_trips(
    spark: SparkSession, raw_root: str, table: VersionedTable, checkpoint: str
) -> None:
    """Months that have landed since the last run."""

    def ingest(files: DataFrame, source: tuple[str, int]) -> None:
        session = files.sparkSession
        months = landed_in(files).select("source_year", "source_month").distinct()
        batches = [(r.source_year, r.source_month) for r in months.collect()]
        if batches:
            rows = audit_trips(read_months(session, raw_root, requested=months))
            VersionedTable(session, table.path).commit(rows, replace=batches, source=source, laid_out=True)

    _take_new_files(spark, raw_root, "*.parquet", checkpoint, ingest)


def catch_up_weather(
    spark: SparkSession, raw_root: str, table: VersionedTable, checkpoint: str
) -> None:
    """Yearly archives that have landed since the last run."""

    def ingest(files: DataFrame, source: tuple[str, int]) -> None:
        session = files.sparkSession
        news = with_year(files).where("source_year IS NOT NULL")
        years = news.select("source_year").distinct()
        # Replacing a year takes all of its archives, wherever they lie, those of
        # earlier runs too; their paths are a handful a year.
        landed = with_year(listed_archives(session, raw_root)).join(years, "source_year", "left_semi")
        archives = [r.source_file for r in landed.unionByName(news).select("source_file").distinct().collect()]
        if archives:
            rows = audit_weather(read_archives(session, archives))
            replaced = [(r.source_year, None) for r in years.collect()]
            VersionedTable(session, table.path).commit(rows, replace=replaced, source=source)

    _take_new_files(spark, raw_root, "*.tar.gz", checkpoint, ingest)
