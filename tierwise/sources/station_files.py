"""Station CSV files, loose or packed in yearly tar.gz archives.

The files differ in which columns they have and in what order, so values are
matched by header name and read as text; types come later, in Silver. Headers are
data: a job finds the first line of every file, and each record is joined with the
header of its file and parsed by Spark's CSV expression for that number of fields.
The driver learns the distinct headers only, however many files there are. A record
that does not fit its header is kept as text in `bad_record`, with what could be
read of it.

Archives are a data source of their own, `station_archives`: a task per archive
reads it as a stream, once, and hands on the records of its members.
"""

from __future__ import annotations

import csv
import json
import tarfile
from collections.abc import Iterable, Iterator, Sequence
from typing import IO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tierwise.schemas import WEATHER_SOURCE
from tierwise.session import fresh_dir
from tierwise.sources.stores import open_stream

# Records of a member are handed on in pieces of about this many bytes, so that
# one huge file is parsed by many tasks and no row is huge.
PIECE_BYTES = 4 << 20
# As Spark writes and reads CSV: a quote inside quotes is doubled.
_CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}


# --- headers -------------------------------------------------------------------


def _names(line: str) -> list[str]:
    """Column names of a header line; those of the contract in its spelling."""
    found = next(csv.reader([line.lstrip("﻿").rstrip("\r\n")]), [])
    fold = {c.upper(): c for c in WEATHER_SOURCE}
    return [fold.get(name.strip().upper(), name.strip()) for name in found]


def _in_order(names: Iterable[str]) -> list[str]:
    seen = {n for n in names if n}
    return [c for c in WEATHER_SOURCE if c in seen] + sorted(seen - set(WEATHER_SOURCE))


def _fields(width: int) -> Column:
    """The fields of `value` as an array, for records of `width` fields, and the
    record itself as `bad` if it has more or fewer."""
    names = [f"_{i}" for i in range(width)]
    schema = ", ".join(f"{n} STRING" for n in (*names, "_bad"))
    # A function of the parsed record, so that it is parsed once and not for every field.
    parsed = F.array(F.from_csv(F.col("value"), schema, _CSV_OPTIONS))
    return F.transform(
        parsed, lambda r: F.struct(F.array(*[r[n] for n in names]).alias("fields"), r["_bad"].alias("bad"))
    )[0]


def parse_records(records: DataFrame, headers: Iterable[str], at_least: Sequence[str] = ()) -> DataFrame:
    """Records (path, header, value) as rows of path, all columns that any of the
    headers or `at_least` names, and bad_record.

    `headers` are the distinct headers of the records. A column that a record's
    header lacks is null, as is an empty field; of a name that a header repeats
    the first counts, and fields without a name are left out.
    """
    layouts = {header: _names(header) for header in headers}
    columns = _in_order([*at_least, *(n for names in layouts.values() for n in names)])
    if not layouts:
        fields = ", ".join(f"`{c}` STRING" for c in ("path", *columns, "bad_record"))
        return records.sparkSession.createDataFrame([], fields)
    # Where each column stands under each header, a row per header: too few keys to shuffle by.
    known = records.sparkSession.createDataFrame(
        [
            (header, len(names), [names.index(c) if c in names else -1 for c in columns])
            for header, names in layouts.items()
        ],
        "header STRING, width INT, places ARRAY<INT>",
    )
    # Few numbers of fields occur; only the branch of a record's own is evaluated.
    widths = sorted({len(names) for names in layouts.values()})
    parsed = F.when(F.col("width") == widths[0], _fields(widths[0]))
    for width in widths[1:]:
        parsed = parsed.when(F.col("width") == width, _fields(width))
    rows = records.join(F.broadcast(known), "header").select("path", "places", parsed.alias("parsed"))
    return rows.select(
        "path",
        *[
            F.get(F.col("parsed.fields"), F.nullif(F.col("places")[i], F.lit(-1))).alias(c)
            for i, c in enumerate(columns)
        ],
        F.col("parsed.bad").alias("bad_record"),
    )


# --- loose files -----------------------------------------------------------------


def file_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of the CSV files below `paths` that are not blank, with their file."""
    lines = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
        .text(paths)
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    )
    return lines.where(F.btrim("value") != "")


def file_headers(lines: DataFrame) -> DataFrame:
    """path and header, the first line of every file.

    Lines are numbered as a task reads them, so that the least number in a file's
    first block is its first line: an aggregate with a row per file.
    """
    first = lines.where("block = 0").withColumn("n", F.monotonically_increasing_id())
    return first.groupBy("path").agg(F.min_by("value", "n").alias("header"))


def read_station_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows of loose station CSVs merged by column name, keeping every column
    found, with the path of their file.

    Headers take a pass over the text of their own; its result, a row per file, is
    stored and joined with all lines. A line that repeats its file's header, as in
    files put together from several, is a header too. Line breaks inside quotes
    end a record here; archives allow them.
    """
    lines = file_lines(spark, paths)
    place = fresh_dir(spark, "file-headers")
    file_headers(lines).write.parquet(place)
    heads = spark.read.schema("path STRING, header STRING").parquet(place)
    records = lines.join(heads, "path").where("value NOT IN (header, concat('\ufeff', header))")
    # As many rows as there are kinds of header.
    kinds = [r.header for r in heads.select("header").distinct().collect()]
    return parse_records(records.select("path", "header", "value"), kinds)


# --- archives ----------------------------------------------------------------------


def read_files(spark: SparkSession, paths: str | Sequence[str], pattern: str) -> DataFrame:
    """Files below `paths` by their names; only `path` is read if nothing else is used."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(paths)
    )


def listed_archives(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """Paths of the archives below a folder."""
    return read_files(spark, root, "*.tar.gz").select("path")


def csv_pieces(stream: IO[bytes], piece_bytes: int = PIECE_BYTES) -> Iterator[tuple[str, list[str]]]:
    """Header and records of a CSV, some megabytes of records at a time. A line
    break inside quotes is not the end of a record; bytes that are not UTF-8 are
    marked; blank lines are left out."""
    header = stream.readline().decode("utf-8", "replace").rstrip("\r\n")
    if not header.strip():
        return
    records: list[str] = []
    open_lines: list[bytes] = []
    size, quotes, sent = 0, 0, False
    for line in stream:
        quotes += line.count(b'"')
        open_lines.append(line)
        if quotes % 2 == 0:
            record = b"".join(open_lines).decode("utf-8", "replace").rstrip("\r\n")
            if record.strip():
                records.append(record)
                size += len(record)
            open_lines = []
        if size >= piece_bytes:
            yield header, records
            records, size, sent = [], 0, True
    if open_lines:  # a quote that is never closed: line by line, so that no record takes the rest along
        records += [r for line in open_lines if (r := line.decode("utf-8", "replace").rstrip("\r\n")).strip()]
    if records or not sent:
        yield header, records


def archive_pieces(stream: IO[bytes]) -> Iterator[tuple[str, str, list[str]]]:
    """Member, header and records of the CSV members of a tar.gz stream, in order."""
    with tarfile.open(fileobj=stream, mode="r|gz") as archive:
        for entry in archive:
            if entry.isfile() and entry.name.endswith(".csv"):
                for header, records in csv_pieces(archive.extractfile(entry)):
                    yield entry.name, header, records


class ArchivePartition(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class StationArchives(DataSource):
    """CSV members of tar.gz archives: path, member, header, and records in pieces.

    Option `paths` lists the archives, as JSON. Gzip cannot be split, so each is a
    partition; it is read as a stream of any length, once. Small members
    are handed on together, up to the size of a piece; a task holds two at most.
    """

    @classmethod
    def name(cls) -> str:
        return "station_archives"

    def schema(self) -> str:
        return "path STRING, member STRING, header STRING, records ARRAY<STRING>"

    def reader(self, schema) -> DataSourceReader:
        return StationArchiveReader(json.loads(self.options["paths"]))


class StationArchiveReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> Sequence[InputPartition]:
        return [ArchivePartition(path) for path in self.paths]

    def read(self, partition: ArchivePartition) -> Iterator[pa.RecordBatch]:
        def together(pieces: list[tuple[str, str, list[str]]]) -> pa.RecordBatch:
            members, headers, records = zip(*pieces)
            return pa.RecordBatch.from_arrays(
                [pa.array([partition.path] * len(pieces)), pa.array(members), pa.array(headers),
                 pa.array(records, pa.list_(pa.string()))], ["path", "member", "header", "records"],
            )

        with open_stream(partition.path) as stream:
            pieces, size = [], 0
            for piece in archive_pieces(stream):
                pieces.append(piece)
                size += sum(map(len, piece[2]))
                if size >= PIECE_BYTES:
                    yield together(pieces)
                    pieces, size = [], 0
            if pieces:
                yield together(pieces)


def unpack_archives(archives: DataFrame, source: type[DataSource] = StationArchives) -> DataFrame:
    """path, member, header and records of the archives that `archives` (path)
    lists, unpacked into the shared folder: what follows reads them from there, by
    as many tasks as their size asks for. One path per archive reaches the driver."""
    spark = archives.sparkSession
    paths = sorted(r.path for r in archives.select("path").distinct().collect())
    place = fresh_dir(spark, "unpacked")
    if paths:
        spark.dataSource.register(source)
        spark.read.format(source.name()).option("paths", json.dumps(paths)).load().write.parquet(place)
        return spark.read.parquet(place)
    return spark.createDataFrame([], StationArchives({}).schema())


def with_year(rows: DataFrame) -> DataFrame:
    """The batch year, from the archive's or folder's name, and the file itself."""
    name = r"(\d{4})[^/]*(?:\.tar\.gz|/[^/]*\.csv)$"
    year = F.regexp_extract("path", name, 1).try_cast("smallint")
    return rows.withColumn("source_year", year).withColumnRenamed("path", "source_file")


def archive_rows(pieces: DataFrame) -> DataFrame:
    """Rows of unpacked archives, with the contract's columns and every other any member has."""
    kinds = [r.header for r in pieces.select("header").distinct().collect()]
    records = pieces.select("path", "header", F.explode("records").alias("value")).where("value <> header")
    return with_year(parse_records(records, kinds, WEATHER_SOURCE))


def read_archives(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Rows of the yearly tar.gz archives below `paths`, ready for the Bronze audit columns."""
    return archive_rows(unpack_archives(listed_archives(spark, paths)))
