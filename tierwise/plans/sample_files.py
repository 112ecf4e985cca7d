"""Raw files in the shapes they arrive in, made from the whole input tables, so
that the file readers can be checked against the same rows."""

from __future__ import annotations

import csv
import io
import itertools
import tarfile
from collections.abc import Iterable, Iterator
from typing import IO

import pyarrow as pa
from pyarrow import fs as filesystem
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.session import fresh_dir, open_writers
from tierwise.sources import tables
from tierwise.sources.month_files import write_months


def month_files(spark: SparkSession, sf_dir: str) -> str:
    """Monthly trip batches with drifting schemas: up to 1997 the passenger
    count is an integer and there is no airport fee, later its name differs."""
    root = fresh_dir(spark, "raw-trips")
    rows = tables.trips(spark, sf_dir)
    early = rows.where("source_year <= 1997").drop("airport_fee")
    write_months(early.withColumn("passenger_count", F.col("passenger_count").cast("bigint")), root)
    late = rows.where("source_year > 1997").withColumnRenamed("airport_fee", "Airport_fee")
    write_months(late, root)
    return root


def station_csvs(spark: SparkSession, sf_dir: str) -> str:
    """Station files with three kinds of header: the usual one, one in another
    order without snow depth, and one with a column of its own."""
    root = fresh_dir(spark, "raw-stations")
    days = tables.weather(spark, sf_dir).drop("source_month")
    number = F.substring("STATION", 2, 3).cast("int") % 3
    usual = days.where(number == 0)
    reordered = days.select(*reversed(days.columns)).drop("SNDP").where(number == 1)
    wider = days.withColumn("NETWORK", F.concat(F.lit("net "), F.col("STATION"))).where(number == 2)
    for df in (usual, reordered, wider):
        with open_writers(spark):  # few years, so a task needs no sort to keep them apart
            df.write.mode("append").option("header", "true").partitionBy("source_year").csv(root)
    return root


class _Archive:
    """A tar.gz under way: members go to its stream as they come."""

    def __init__(self, stream: IO[bytes]):
        self.stream = stream
        self.tar = tarfile.open(fileobj=stream, mode="w|gz", compresslevel=6)

    def add(self, name: str, data: bytes) -> None:
        entry = tarfile.TarInfo(name)
        entry.size = len(data)
        self.tar.addfile(entry, io.BytesIO(data))

    def close(self) -> None:
        self.tar.close()
        self.stream.close()


def _members(batch: pa.RecordBatch) -> Iterator[tuple[int, str, bytes]]:
    """Year, station and CSV of a batch's rows of one station and year, in their order."""
    names = [n for n in batch.schema.names if n != "source_year"]
    table = pa.Table.from_batches([batch]).append_column("_row", pa.array(range(batch.num_rows)))
    table = table.sort_by([("source_year", "ascending"), ("STATION", "ascending"), ("_row", "ascending")])
    header = io.StringIO()
    csv.writer(header).writerow(names)
    years, stations = table["source_year"].to_pylist(), table["STATION"].to_pylist()
    rows = zip(*(table[n].to_pylist() for n in names))
    for (year, station), group in itertools.groupby(zip(years, stations, rows), lambda r: r[:2]):
        text = io.StringIO()
        text.write(header.getvalue())
        csv.writer(text).writerows(row for _, _, row in group)
        yield year, station, text.getvalue().encode()


def land_archives(days: DataFrame, root: str) -> None:
    """Write station days as tar.gz archives below `root`, one per year and task, by
    the tasks themselves: every batch of a task adds members to its archives."""

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = filesystem.FileSystem.from_uri(root if "://" in root else f"file://{root}")
        task = TaskContext.get().partitionId()
        store.create_dir(f"{folder}/raw", recursive=True)
        paths: dict[int, str] = {}
        under_way: dict[int, _Archive] = {}
        for number, batch in enumerate(batches):
            for year, station, data in _members(batch):
                if year not in under_way:
                    paths[year] = f"raw/{year}-{task}.tar.gz"
                    under_way[year] = _Archive(store.open_output_stream(f"{folder}/{paths[year]}", compression=None))
                under_way[year].add(f"{year}/{station}-{number}.csv", data)
        for archive in under_way.values():
            archive.close()
        yield pa.RecordBatch.from_pydict({"path": pa.array(paths.values(), pa.string())})

    texts = days.select(
        *[F.col(f"`{c}`").cast("string").alias(c) for c in days.columns if c != "source_year"],
        "source_year",
    )
    texts.mapInArrow(write, "path STRING").count()
