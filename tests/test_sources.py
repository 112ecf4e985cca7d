from __future__ import annotations

import io
import json
import tarfile

import pytest

from tests.rows import GOOD_TRIP, trips
from tierwise import session
from tierwise.operators.batches import BatchRange
from tierwise.operators.bronze import audit_weather
from tierwise.schemas import WEATHER_SOURCE
from tierwise.plans import sample_files
from tierwise.sources import month_files, station_files, zone_lookup

FIRST = "STATION,DATE,TEMP,NAME\n100,2023-01-01,50.0,\"JAN MAYEN, NO\"\n100,2023-01-02,,X\n"
REORDERED = "TEMP,station,DATE\r\n60.5,A00002,2023-02-01\r\n"
WIDER = "STATION,DATE,NEW_COLUMN\nA00003,2023-03-01,extra\n"


@pytest.fixture
def csv_folder(tmp_path):
    folder = tmp_path / "2023"
    folder.mkdir()
    for name, text in {"a": FIRST, "b": REORDERED, "c": WIDER}.items():
        (folder / f"{name}.csv").write_text(text, newline="")
    return str(tmp_path)


def test_csvs_are_merged_by_name(spark, csv_folder):
    df = station_files.with_year(station_files.read_station_files(spark, csv_folder))
    named = ["STATION", "DATE", "NAME", "TEMP", "NEW_COLUMN", "source_year"]
    assert df.columns == ["source_file", *named[:-1], "bad_record", "source_year"]
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    assert {r.source_file.rsplit("/", 1)[1] for r in df.collect()} == {"a.csv", "b.csv", "c.csv"}
    rows = sorted(map(tuple, df.select(named).collect()), key=lambda r: r[1])
    assert rows == [
        ("100", "2023-01-01", "JAN MAYEN, NO", "50.0", None, 2023),
        ("100", "2023-01-02", "X", None, None, 2023),
        ("A00002", "2023-02-01", None, "60.5", None, 2023),
        ("A00003", "2023-03-01", None, None, "extra", 2023),
    ]


def test_yearly_archives(spark, tmp_path):
    for year in (2022, 2023):
        with tarfile.open(tmp_path / f"{year}.tar.gz", "w:gz") as archive:
            for name, text in {"a": FIRST, "b": REORDERED, "deep/c": WIDER, "readme.txt": "no"}.items():
                data = text.replace("2023", str(year)).encode()
                entry = tarfile.TarInfo(f"{year}/{name}" + ("" if "." in name else ".csv"))
                entry.size = len(data)
                archive.addfile(entry, io.BytesIO(data))
    df = audit_weather(station_files.read_archives(spark, str(tmp_path)))
    assert df.count() == 8
    assert set(WEATHER_SOURCE) <= set(df.columns)
    got = {(r.source_year, r.source_month, r.source_file.rsplit("/", 1)[1]) for r in df.collect()}
    assert got == {(y, m, f"{y}.tar.gz") for y in (2022, 2023) for m in (1, 2, 3)}
    # A column that the contract does not know is kept.
    assert {r.NEW_COLUMN for r in df.collect()} == {None, "extra"}


def write_archive(path, text: bytes) -> None:
    with tarfile.open(path, "w:gz") as archive:
        entry = tarfile.TarInfo("a.csv")
        entry.size = len(text)
        archive.addfile(entry, io.BytesIO(text))


# One byte that is not UTF-8, and a record with a field too few.
BROKEN = b"STATION,DATE,NAME\n1,2023-01-01,CAF\xc9\n2,2023-01-02\n3,2023-01-03,OK\n"


def test_bad_records_are_kept_and_counted(spark, tmp_path):
    (tmp_path / "2023").mkdir()
    (tmp_path / "2023" / "a.csv").write_bytes(BROKEN)
    write_archive(tmp_path / "2023.tar.gz", BROKEN)
    loose = station_files.read_station_files(spark, str(tmp_path))
    packed = station_files.read_archives(spark, str(tmp_path))
    for df in (loose, packed):
        assert df.where("bad_record IS NOT NULL").count() == 1
        good = df.where("bad_record IS NULL").select("STATION", "NAME").orderBy("STATION").collect()
        assert [tuple(r) for r in good] == [("1", "CAF\ufffd"), ("3", "OK")]


def test_a_large_csv_is_cut_between_records():
    records = [f'{i},"two\nlines {i}"' for i in range(100)]
    text = "id,note\n" + "\r\n\n".join(records)
    pieces = list(station_files.csv_pieces(io.BytesIO(text.encode()), piece_bytes=100))
    assert len(pieces) > 5 and {header for header, _ in pieces} == {"id,note"}
    assert [r for _, part in pieces for r in part] == records
    # A quote that nothing closes takes no other line along.
    assert list(station_files.csv_pieces(io.BytesIO(b'a,b\n1,"x\n2,y\n'))) == [("a,b", ['1,"x', "2,y"])]
    assert list(station_files.csv_pieces(io.BytesIO(b"a,b\n"))) == [("a,b", [])]
    assert list(station_files.csv_pieces(io.BytesIO(b""))) == []


class EndlessTar(io.RawIOBase):
    """A tar.gz of one CSV member, made while it is read: `total` bytes of records."""

    def __init__(self, total: int):
        self.made, self.most_asked, self.source = 0, 0, self._source(total)
        self.left = b""

    def _source(self, total: int):
        import zlib

        record = b"A00001,2023-01-01,50.5\n" * 4096
        count = total // len(record)
        entry = tarfile.TarInfo("2023/a.csv")
        entry.size = len(b"STATION,DATE,TEMP\n") + count * len(record)
        pack = zlib.compressobj(1, zlib.DEFLATED, 31)
        yield pack.compress(entry.tobuf() + b"STATION,DATE,TEMP\n")
        for _ in range(count):
            yield pack.compress(record)
            self.made += len(record)
        yield pack.compress(b"\0" * (-entry.size % 512 + 1024)) + pack.flush()

    def read(self, size: int = -1) -> bytes:
        self.most_asked = max(self.most_asked, size)
        while len(self.left) < size and (more := next(self.source, None)) is not None:
            self.left += more
        out, self.left = self.left[:size], self.left[size:]
        return out


def test_archives_are_streams():
    """Records come while most of the archive has not been made yet, in pieces of
    bounded size, so its length does not matter."""
    stream = EndlessTar(300 << 20)
    pieces = station_files.archive_pieces(stream)
    member, header, records = next(pieces)
    assert (member, header) == ("2023/a.csv", "STATION,DATE,TEMP") and stream.made < 40 << 20
    sizes = [sum(map(len, records))]
    for _, _, records in pieces:
        sizes.append(sum(map(len, records)))
    assert max(sizes) <= station_files.PIECE_BYTES + 100 and sum(sizes) > 250 << 20
    assert stream.most_asked < 1 << 20


def test_every_archive_is_read_once(spark, tmp_path):
    """Headers and rows come from one read of each archive."""
    for year in (2021, 2022, 2023):
        write_archive(tmp_path / f"{year}.tar.gz", FIRST.replace("2023", str(year)).encode())
    opened = tmp_path / "opened"
    opened.mkdir()

    class CountedReader(station_files.StationArchiveReader):
        def read(self, partition):
            import uuid

            (opened / f"{partition.path.rsplit('/', 1)[1]}-{uuid.uuid4().hex}").touch()
            return super().read(partition)

    class Counted(station_files.StationArchives):
        @classmethod
        def name(cls):
            return "counted_archives"

        def reader(self, schema):
            return CountedReader(json.loads(self.options["paths"]))

    pieces = station_files.unpack_archives(station_files.listed_archives(spark, str(tmp_path)), Counted)
    rows = station_files.archive_rows(pieces)
    assert rows.count() == 6 and rows.where("TEMP = '50.0'").count() == 3
    assert sorted(p.name.split("-")[0] for p in opened.iterdir()) == ["2021.tar.gz", "2022.tar.gz", "2023.tar.gz"]


def test_no_archives(spark, tmp_path):
    df = station_files.read_archives(spark, str(tmp_path))
    assert df.count() == 0 and set(WEATHER_SOURCE) <= set(df.columns)


def test_many_files_and_few_headers(spark, tmp_path):
    """5,000 files: headers are found by a job, the driver asks for none of them."""
    kinds = ["STATION,DATE,TEMP", "TEMP,STATION,DATE", "DATE,STATION,NEW_COLUMN,TEMP"]
    for i in range(5000):
        folder = tmp_path / str(2000 + i % 20)
        folder.mkdir(exist_ok=True)
        day = f"2023-01-{i % 28 + 1:02d}"
        row = [f"S{i},{day},{i}.5", f"{i}.5,S{i},{day}", f'{day},S{i},"x, ""{i}""",{i}.5'][i % 3]
        (folder / f"{i}.csv").write_text(f"{kinds[i % 3]}\n{row}\n")
    heads = station_files.file_headers(station_files.file_lines(spark, str(tmp_path)))
    assert {(r.header, r["count"]) for r in heads.groupBy("header").count().collect()} == {
        (kinds[0], 1667), (kinds[1], 1667), (kinds[2], 1666)
    }
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "")
    df = station_files.read_station_files(spark, str(tmp_path))
    jobs = len(tracker.getJobIdsForGroup("headers"))
    spark.sparkContext.setJobGroup("", "")
    assert jobs < 12  # listing, one pass, its store, the distinct headers
    assert df.columns == ["path", "STATION", "DATE", "TEMP", "NEW_COLUMN", "bad_record"]
    rows = {r.STATION: r for r in df.collect()}
    assert len(rows) == 5000 and all(rows[f"S{i}"].TEMP == f"{i}.5" for i in range(5000))
    assert rows["S2"].NEW_COLUMN == 'x, "2"' and rows["S3"].NEW_COLUMN is None
    assert all(r.bad_record is None for r in rows.values())


def test_a_large_file_in_many_blocks(spark, tmp_path):
    """Only the first block begins with the header; all of them are parsed by it."""
    lines = [f"S{i},2023-01-01,{i}" for i in range(20_000)]
    (tmp_path / "a.csv").write_text("\n".join(["\ufeffSTATION,DATE,TEMP", *lines[:9000], "\ufeffSTATION,DATE,TEMP", "", *lines[9000:]]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = station_files.read_station_files(spark, str(tmp_path))
        assert station_files.file_lines(spark, str(tmp_path)).select("block").distinct().count() > 5
        assert sorted(int(r.TEMP) for r in df.select("TEMP").collect()) == list(range(20_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_with_only_a_header_has_no_rows(spark, tmp_path):
    folder = tmp_path / "2023"
    folder.mkdir()
    (folder / "a.csv").write_text("STATION,DATE\n")
    (folder / "b.csv").write_text("")
    (folder / "c.csv").write_text(FIRST)
    assert station_files.read_station_files(spark, str(tmp_path)).count() == 2


def drifting_months(spark, root):
    whole = trips(spark, {}, {"passenger_count": None})
    whole.drop("airport_fee", "source_year", "source_month").withColumn(
        "passenger_count", whole.passenger_count.cast("bigint")
    ).write.parquet(f"{root}/2021-01.parquet")
    whole.drop("source_year", "source_month").write.parquet(f"{root}/2021-02.parquet")
    whole.drop("source_year", "source_month").withColumnRenamed("airport_fee", "Airport_Fee").withColumn(
        "PULocationID", whole.PULocationID.cast("int")
    ).write.parquet(f"{root}/2021-03.parquet")


def test_drifting_month_files(spark, tmp_path):
    drifting_months(spark, tmp_path)
    df = month_files.read_months(spark, str(tmp_path))
    assert df.columns == [*GOOD_TRIP, "source_file"]
    assert dict(df.dtypes)["passenger_count"] == "double"
    assert dict(df.dtypes)["PULocationID"] == "bigint"
    got = sorted((r.source_month, r.passenger_count or 0, r.airport_fee) for r in df.collect())
    assert got == [(1, 0, None), (1, 2.0, None), (2, 0, 0.0), (2, 2.0, 0.0), (3, 0, 0.0), (3, 2.0, 0.0)]


def test_the_month_of_a_path(spark):
    """The first `.parquet` after a month counts, whatever ends in `.parquet` before it."""
    paths = {
        "file:///x/2023-01.parquet": "2023-01",
        "file:///x/batch=2024-12.parquet/part-0.c000.snappy.parquet": "2024-12",
        "file:///x/all.parquet/2023-02.parquet/2022-05.parquet": "2023-02",
        "file:///x/2023-13.parquet/trips_2023-03.parquet": "2023-03",
        "file:///x/2023-04.parquet/2021-05.parquet": "2023-04",
    }
    df = spark.createDataFrame([(p,) for p in paths], "path STRING")
    assert {r.path: r.month for r in df.select("path", month_files.month_of("path").alias("month")).collect()} == paths


def test_months_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    used = []
    monkeypatch.setattr(month_files, "open_writers", lambda s: used.append(s) or session.open_writers(s))
    month_files.write_months(trips(spark, {}, {"source_month": 2}, {"source_year": 2022}), str(tmp_path))
    assert used
    found = month_files.read_months(spark, str(tmp_path)).select("source_year", "source_month").collect()
    assert sorted(map(tuple, found)) == [(2022, 1), (2023, 1), (2023, 2)]


def test_two_schemas_in_one_batch(spark, tmp_path):
    whole = trips(spark, {}).drop("source_year", "source_month")
    batch = f"{tmp_path}/2021-05.parquet"
    whole.drop("airport_fee").coalesce(1).write.parquet(batch)
    whole.selectExpr("*", "'x' AS new_column").coalesce(1).write.mode("append").parquet(batch)
    df = month_files.read_months(spark, str(tmp_path))
    got = sorted(((r.airport_fee, r.new_column) for r in df.collect()), key=str)
    assert got == [(0.0, "x"), (None, None)]
    # A column of two types: each file is read as it was written.
    whole.withColumn("passenger_count", whole.passenger_count.cast("string")).coalesce(1).write.mode("append").parquet(batch)
    df = month_files.read_months(spark, str(tmp_path))
    assert [r.passenger_count for r in df.collect()] == [2.0] * 3
    assert all(r.source_file.startswith("file:") and "/2021-05.parquet/part-" in r.source_file for r in df.collect())


def test_footers_of_all_batches_in_one_job(spark, tmp_path):
    """The number of jobs does not depend on the number of months."""
    tracker = spark.sparkContext.statusTracker()
    jobs = []
    for year in (2020, 2022):
        root = f"{tmp_path}/{year}"
        for month in range(1, 5 if year == 2020 else 13):
            drop = ["source_year", "source_month"] + (["airport_fee"] if month % 2 else [])
            trips(spark, {}).drop(*drop).coalesce(1).write.parquet(f"{root}/{year}-{month:02d}.parquet")
        spark.sparkContext.setJobGroup(f"months-{year}", "")
        df = month_files.read_months(spark, root)
        jobs.append(len(tracker.getJobIdsForGroup(f"months-{year}")))
        spark.sparkContext.setJobGroup("", "")
        assert df.count() == (4 if year == 2020 else 12)
    assert jobs[0] == jobs[1] <= 4


def test_footers_that_spark_has_not_written(spark, tmp_path):
    import datetime

    import pyarrow as pa
    from pyarrow import parquet

    when = datetime.datetime(2023, 1, 1, 12, 30)
    table = pa.table({
        "tpep_pickup_datetime": pa.array([when], pa.timestamp("us")), "tpep_dropoff_datetime": pa.array([when], pa.timestamp("us")),
        "passenger_count": pa.array([2], pa.int64()), "fare_amount": pa.array([1.5], pa.float64()), "note": pa.array(["x"], pa.large_string()),
    })
    parquet.write_table(table, tmp_path / "2023-01.parquet")
    parquet.write_table(table, tmp_path / "2023-02.parquet", use_deprecated_int96_timestamps=True)
    for month in (1, 2):
        path = f"{tmp_path}/2023-0{month}.parquet"
        seen = month_files.footers(spark.createDataFrame([(path,)], "path string")).first().schema
        theirs = spark.read.parquet(path).schema
        assert [(f["name"], f["type"]) for f in json.loads(seen)["fields"]] == [
            (f.name, f.dataType.jsonValue()) for f in theirs
        ]
    rows = month_files.read_months(spark, str(tmp_path)).orderBy("source_month").collect()
    assert [r.tpep_pickup_datetime for r in rows] == [when, when] and [r.passenger_count for r in rows] == [2.0, 2.0]


def test_stray_files_are_reported_and_left(spark, tmp_path):
    drifting_months(spark, tmp_path)
    for name in ("notes.parquet", "2021-13.parquet"):
        trips(spark, {}).write.parquet(f"{tmp_path}/{name}")
    assert month_files.read_months(spark, str(tmp_path)).count() == 6
    stray = month_files.stray_files(month_files.listed_files(spark, str(tmp_path)))
    assert {r.path.split("/")[-2] for r in stray.collect()} == {"notes.parquet", "2021-13.parquet"}


def test_all_missing_months_are_named(spark, tmp_path):
    drifting_months(spark, tmp_path)
    wanted = BatchRange((2019, 1), (2021, 3)).calendar(spark)
    with pytest.raises(FileNotFoundError) as error:
        month_files.read_months(spark, str(tmp_path), wanted)
    assert str(error.value).count("-") >= 24 and "2020-12" in str(error.value)


def test_missing_month_is_an_error(spark, tmp_path):
    drifting_months(spark, tmp_path)
    wanted = BatchRange((2021, 2), (2021, 4)).calendar(spark)
    with pytest.raises(FileNotFoundError, match="2021-04"):
        month_files.read_months(spark, str(tmp_path), wanted)
    there = BatchRange((2021, 2), (2021, 3)).calendar(spark)
    assert month_files.read_months(spark, str(tmp_path), there).count() == 4


def test_zone_names_are_never_null(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
        '264,"Unknown","N/A","N/A"\n265,"N/A","Outside of NYC","N/A"\n'
    )
    rows = [tuple(r) for r in zone_lookup.read_zones(spark, str(path)).orderBy("LocationID").collect()]
    assert rows[1] == (264, "Unknown", "N/A", "N/A") and rows[2][1] == "N/A"


def test_samples_land_as_one_archive_per_year_and_task(spark, tmp_path):
    """However many batches a task has; small members are read together."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        days = spark.range(0, 40, numPartitions=1).selectExpr(
            "concat('S', id % 3) AS STATION", "'1995-01-01' AS DATE", "CAST(id AS DOUBLE) AS TEMP", "1995 + id % 2 AS source_year"
        )
        sample_files.land_archives(days, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    paths = sorted(tmp_path.rglob("*.tar.gz"))
    assert [p.name for p in paths] == ["1995-0.tar.gz", "1996-0.tar.gz"]
    reader = station_files.StationArchiveReader([str(paths[0])])
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert len(batches) == 1 and batches[0].num_rows > 3
    rows = station_files.read_archives(spark, str(tmp_path)).select("source_year", "STATION", "TEMP").collect()
    assert sorted((r.source_year, r.STATION, float(r.TEMP)) for r in rows) == sorted((1995 + i % 2, f"S{i % 3}", float(i)) for i in range(40))


def test_records_are_not_shuffled_by_header(spark):
    """There are few headers, so all records would meet in a few tasks."""
    records = spark.range(4).selectExpr("'f' AS path", "'STATION,TEMP' AS header", "concat('S,', id) AS value")
    rows = station_files.parse_records(records, ["STATION,TEMP"])
    assert "hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.TEMP for r in rows.collect()) == ["0", "1", "2", "3"]
