from __future__ import annotations

import datetime
import io
import tarfile

import pytest

from tests.rows import days, trips
from tierwise.operators import batches, quality
from tierwise.operators.rules import trip_rules
from tierwise.operators.versions import VersionedTable
from tierwise.plans import pipeline
from tierwise.session import fresh_dir
from tierwise.sources.month_files import write_months
from tierwise.streaming.catchup import catch_up_trips, catch_up_weather

ZONES = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
ANY = (1, 10**9)


def month(m, **more):
    start = datetime.datetime(2023, m, 15, 8, 0)
    return {
        "tpep_pickup_datetime": start,
        "tpep_dropoff_datetime": start + datetime.timedelta(minutes=30),
        "source_month": m,
        **more,
    }


def rows(flow):
    return {r.table: r.rows for r in flow.summary().collect()}


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(10, "B", "Z", "S")], ZONES)


def test_failed_batch_stops_and_others_go_on(spark, zones):
    # Payment code 9 has no name, which the Silver suite does not accept.
    raw = trips(spark, month(1), month(2, payment_type=9), month(3, fare_amount=0.0))
    flow = pipeline.run_trips(spark, raw, zones, fresh_dir(spark, "flow"), pipeline.trip_domain(ANY, ANY))
    found = rows(flow)
    assert (found["bronze"], found["silver"], found["gold_hourly_summary"]) == (3, 2, 1)
    report = quality.read_report(spark, flow.report_path).where("layer = 'silver'")
    verdict = {r.batch: r.success for r in quality.verdicts(report).collect()}
    # March lost all its rows in cleaning: reported, and not passed over.
    assert verdict == {"2023_01": True, "2023_02": False, "2023_03": False}


def test_nothing_passes_bronze(spark, zones):
    flow = pipeline.run_trips(spark, trips(spark, month(1)), zones, fresh_dir(spark, "flow"))
    assert rows(flow)["bronze"] == 1 and rows(flow)["silver"] == 0
    assert not flow.silver.exists() and not flow.gold("hourly_summary").exists()


def test_replaying_a_batch(spark, zones):
    domain, root = pipeline.trip_domain(ANY, ANY), fresh_dir(spark, "flow")
    flow = pipeline.run_trips(spark, trips(spark, month(1), month(2)), zones, root, domain)
    before = sorted(map(str, flow.gold("zone_performance").read().collect()))
    pipeline.run_trips(spark, trips(spark, month(2)), zones, root, domain)
    assert sorted(map(str, flow.gold("zone_performance").read().collect())) == before
    pipeline.run_trips(spark, trips(spark, month(2, fare_amount=30.0), month(2)), zones, root, domain)
    totals = {r.source_month: r.total_trips for r in flow.gold("hourly_summary").read().collect()}
    assert totals == {1: 1, 2: 2}


def test_raw_rows_are_read_once(spark, zones, monkeypatch):
    """The batches are those that were stored; nothing asks the raw rows for them first."""
    monkeypatch.setattr(pipeline, "batches_of", lambda *_: pytest.fail("raw rows were read for their batches"))
    domain = pipeline.trip_domain(ANY, ANY)
    flow = pipeline.run_trips(spark, trips(spark, month(1), month(3)), zones, fresh_dir(spark, "flow"), domain)
    assert flow.bronze.replaced(0) == [(2023, 1), (2023, 3)]
    assert rows(flow)["gold_hourly_summary"] == 2


def test_weather_year_needs_all_months_and_unique_days(spark):
    year = [
        {"DATE": f"{y}-{m:02d}-01", "source_year": y, "source_month": m, "SNDP": "0", **extra}
        for y in (2021, 2022)
        for m in range(1, 13)
        for extra in ([{}, {}] if (y, m) == (2022, 5) else [{}])
    ]
    raw = days(spark, *year)
    for c in quality.WEATHER_BRONZE_COLUMNS:
        if c not in raw.columns and c not in ("ingested_at", "source_file"):
            raw = raw.selectExpr("*", f"CAST(NULL AS STRING) AS `{c}`")
    flow = pipeline.run_weather(spark, raw, fresh_dir(spark, "flow"), pipeline.weather_domain(ANY, ANY))
    found = rows(flow)
    assert (found["bronze"], found["silver"], found["gold_daily_climate"]) == (25, 25, 12)
    gold = flow.gold("station_metrics").read()
    assert gold.where("temp_stddev_f IS NULL").count() == 12
    assert gold.where("avg_snow_depth_in IS NULL AND snow_days = 0").count() == 12


def test_backfill_reports_every_requested_month(spark):
    raw = trips(spark, month(1), month(2, fare_amount=0.0))
    wanted = batches.BatchRange.of_year(2023, 1, 3).calendar(spark)
    summary = batches.backfill_summary(wanted, raw, trip_rules())
    assert {(r.batch, r.bronze_rows, r.silver_rows, r.status) for r in summary.collect()} == {
        ("2023-01", 1, 1, "success"),
        ("2023-02", 1, 0, "failed"),
        ("2023-03", 0, 0, "failed"),
    }
    totals = batches.summary_totals(summary).first()
    assert (totals.successful, totals.failed, totals.failed_batches) == (1, 2, "2023-02, 2023-03")


@pytest.mark.parametrize(
    "bad",
    [
        lambda: batches.BatchRange((2023, 5), (2023, 4)),
        lambda: batches.BatchRange((2023, 0), (2023, 4)),
        lambda: batches.BatchRange((2023, 1), (2023, 13)),
        lambda: batches.BatchRange((2008, 1), (2023, 1)),
        lambda: batches.BatchRange((2023, 1), (2999, 1)),
        lambda: batches.BatchRange.of_year(2023, month_start=3),
        lambda: batches.BatchRange.of_year(1928, earliest_year=batches.FIRST_WEATHER_YEAR),
    ],
)
def test_bad_ranges(bad):
    with pytest.raises(ValueError):
        bad()


def test_catch_up_takes_only_what_is_new(spark):
    root, state = fresh_dir(spark, "raw"), fresh_dir(spark, "state")
    table = VersionedTable(spark, fresh_dir(spark, "caught-up"))

    def run():
        catch_up_trips(spark, root, table, state)
        return {(r.source_month, r["count"]) for r in table.read().groupBy("source_month").count().collect()}

    write_months(trips(spark, month(1), month(2)), root)
    assert run() == {(1, 1), (2, 1)}
    version = table.latest_version()
    assert run() == {(1, 1), (2, 1)} and table.latest_version() == version
    # More files of a month that was there already: the month is complete.
    write_months(trips(spark, month(2), month(3)), root)
    assert run() == {(1, 1), (2, 2), (3, 1)}
    assert table.history(1).first().predicate == (
        "source_year = 2023 AND source_month = 2 OR source_year = 2023 AND source_month = 3"
    )


def test_a_stream_that_fails_after_its_commit_makes_one_version(spark, monkeypatch):
    """The batch comes again, since its checkpoint is missing, and is known."""
    root, state = fresh_dir(spark, "raw"), fresh_dir(spark, "state")
    table = VersionedTable(spark, fresh_dir(spark, "caught-up"))
    write_months(trips(spark, month(1), month(2)), root)
    commit = VersionedTable.commit

    def failing(self, *args, **more):
        commit(self, *args, **more)
        raise RuntimeError("lost after the commit")

    monkeypatch.setattr(VersionedTable, "commit", failing)
    with pytest.raises(Exception, match="lost after the commit"):
        catch_up_trips(spark, root, table, state)
    monkeypatch.undo()
    assert table.latest_version() == 0
    catch_up_trips(spark, root, table, state)
    assert table.latest_version() == 0 and table.read().count() == 2
    write_months(trips(spark, month(3)), root)
    catch_up_trips(spark, root, table, state)
    assert table.latest_version() == 1 and table.read().count() == 3


def test_weather_catch_up_replaces_years(spark, tmp_path):
    table = VersionedTable(spark, fresh_dir(spark, "caught-up"))

    def land(name, *dates):
        data = "STATION,DATE,TEMP\n" + "".join(f"1,{d},50\n" for d in dates)
        with tarfile.open(tmp_path / name, "w:gz") as archive:
            entry = tarfile.TarInfo("1.csv")
            entry.size = len(data)
            archive.addfile(entry, io.BytesIO(data.encode()))
        catch_up_weather(spark, str(tmp_path), table, f"{table.path}-state")
        return {(r.source_year, r["count"]) for r in table.read().groupBy("source_year").count().collect()}

    assert land("2021.tar.gz", "2021-01-01", "2021-02-01") == {(2021, 2)}
    assert land("2022.tar.gz", "2022-01-01") == {(2021, 2), (2022, 1)}
    assert land("2021-late.tar.gz", "2021-12-31") == {(2021, 3), (2022, 1)}
    assert table.history(1).first().predicate == "source_year = 2021"
    # Below another folder, with a prefix, with an unreadable date, and not of any year.
    (tmp_path / "sub").mkdir()
    assert land("sub/2022.tar.gz", "2022-03-01", "2022-04-01") == {(2021, 3), (2022, 3)}
    assert land("gsod_2022.tar.gz", "2022-05-01", "someday") == {(2021, 3), (2022, 5)}
    assert table.read().where("source_month IS NULL").count() == 1
    assert land("notes.tar.gz", "2020-01-01") == {(2021, 3), (2022, 5)}
    names = {r.source_file.rsplit("/", 1)[1] for r in table.read().select("source_file").distinct().collect()}
    assert names == {"2021.tar.gz", "2021-late.tar.gz", "2022.tar.gz", "gsod_2022.tar.gz"}


def test_stray_parquet_does_not_stop_catch_up(spark):
    root, state = fresh_dir(spark, "raw"), fresh_dir(spark, "state")
    table = VersionedTable(spark, fresh_dir(spark, "caught-up"))
    write_months(trips(spark, month(1)), root)
    spark.range(1).write.parquet(f"{root}/notes.parquet")
    catch_up_trips(spark, root, table, state)
    assert table.read().count() == 1
