"""Every query by name. Clock columns are left out of compared results."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tierwise.operators import batches, dashboards, gold, pruning, quality, serving
from tierwise.operators.bronze import audit_trips, audit_weather
from tierwise.operators.rules import drop_report, trip_rules, weather_rules
from tierwise.operators.silver import WEATHER_METRICS, new_columns
from tierwise.operators.versions import VersionedTable, filled_changes
from tierwise.plans import layers, sample_files, stored
from tierwise.session import configure, fresh_dir
from tierwise.sources import month_files, station_files, tables, zone_lookup
from tierwise.streaming.catchup import catch_up_trips, catch_up_weather

Query = Callable[[SparkSession, str], DataFrame]

_CLOCKS = (
    "ingested_at",
    "processed_at",
    "bronze_ingested_at",
    "silver_processed_at",
)


def _without_clocks(plan: Query) -> Query:
    return lambda spark, sf_dir: plan(spark, sf_dir).drop(*_CLOCKS)


def _trip_gold(name: str) -> Query:
    # The daily, hourly, date and payment models use no zone column, so the
    # joins that cannot change their rows are not planned for them.
    source = layers.zoned_trips if name == "zone_performance" else layers.staged_trips
    model = gold.TRIP_MODELS[name]
    return lambda spark, sf_dir: gold.ordered(name, model.build(source(spark, sf_dir)))


def _daily_climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-level, so sorted as its files are: within partitions."""
    days = gold.daily_climate(layers.staged_weather(spark, sf_dir))
    return days.sortWithinPartitions(*gold.sort_columns("daily_climate")).drop(*_CLOCKS)


def _weather_gold(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: gold.ordered(name, build(layers.staged_weather(spark, sf_dir))).drop(
        *_CLOCKS
    )


def _one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.trip_models_in_one_pass(layers.zoned_trips(spark, sf_dir))


def _enriched_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that cleaning adds to Bronze, with how many rows have a value."""
    return new_columns(layers.bronze_trips(spark, sf_dir), layers.clean_trips(spark, sf_dir))


def _trips_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips, each required column empty on some zone pair of its own."""
    pairs = {
        "tpep_pickup_datetime": (3, 4), "tpep_dropoff_datetime": (5, 6), "PULocationID": (7, 8),
        "DOLocationID": (9, 10), "fare_amount": (11, 12), "trip_distance": (13, 14), "payment_type": (15, 16),
    }
    return tables.trips(spark, sf_dir).withColumns(
        {
            c: F.expr(f"CASE WHEN PULocationID != {pu} OR DOLocationID != {do} THEN `{c}` END")
            for c, (pu, do) in pairs.items()
        }
    )


def _days_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station days, each required column empty in one station's month, and
    dates of the future and of another year in two more."""
    places = {
        "TEMP": ("S003", 3), "WDSP": ("S004", 4), "VISIB": ("S005", 5), "PRCP": ("S006", 6),
        "LATITUDE": ("S007", 7), "LONGITUDE": ("S008", 8), "STATION": ("S009", 9),
    }
    gaps = {
        c: F.expr(f"CASE WHEN STATION != '{station}' OR source_month != {month} THEN `{c}` END")
        for c, (station, month) in places.items()
    }
    gaps["DATE"] = F.expr(
        "CASE WHEN STATION = 'S010' AND source_month = 10 THEN NULL"
        " WHEN STATION = 'S001' AND source_month = 1 THEN DATE'2999-01-01'"
        " WHEN STATION = 'S002' AND source_month = 2 THEN add_months(DATE, 12) ELSE DATE END"
    )
    return tables.weather(spark, sf_dir).withColumns(gaps)


def _layer_queries() -> dict[str, Query]:
    return {
        "bronze_trips": _without_clocks(layers.bronze_trips),
        "bronze_weather": _without_clocks(layers.bronze_weather),
        "silver_trips": _without_clocks(layers.clean_trips),
        "silver_weather": _without_clocks(layers.clean_weather),
        "stg_trips": _without_clocks(layers.staged_trips),
        "stg_weather": _without_clocks(layers.staged_weather),
        "zone_lookup": tables.zones,
        "trips_with_zones": _without_clocks(layers.zoned_trips),
        "enriched_columns": _enriched_columns,
        "drop_report": lambda s, d: drop_report(tables.trips(s, d), trip_rules()),
        "drop_report_weather": lambda s, d: drop_report(tables.weather(s, d), weather_rules()),
        "drop_report_gaps": lambda s, d: drop_report(_trips_with_gaps(s, d), trip_rules()),
        "drop_report_weather_gaps": lambda s, d: drop_report(_days_with_gaps(s, d), weather_rules()),
    }


def _gold_queries() -> dict[str, Query]:
    return {
        "gold_weekday_summary": _trip_gold("daily_summary"),
        "gold_hourly_summary": _trip_gold("hourly_summary"),
        "gold_date_summary": _trip_gold("individual_day_summary"),
        "gold_payment_summary": _trip_gold("payment_summary"),
        "gold_zone_performance": _trip_gold("zone_performance"),
        "gold_trips_one_pass": _one_pass,
        "gold_daily_climate": _daily_climate,
        "gold_monthly_climate": _weather_gold("monthly_climate", gold.monthly_climate),
        "gold_station_metrics": _weather_gold("station_metrics", gold.station_metrics),
        "gold_station_longterm": _weather_gold("station_longterm", gold.station_longterm),
    }


def _dashboard_queries() -> dict[str, Query]:
    return {
        "dash_revenue_by_year": lambda s, d: dashboards.revenue_by_year(layers.staged_trips(s, d)),
        "dash_fare_trend": lambda s, d: dashboards.fare_trend(layers.staged_trips(s, d)),
        "dash_zone_hour": lambda s, d: dashboards.zone_hour(layers.zoned_trips(s, d)),
        "dash_weather_trend": lambda s, d: dashboards.weather_trend(layers.staged_weather(s, d)),
    }


# The month and year the scans ask for.
SCAN_YEAR, SCAN_MONTH = 1996, 6
# First and last batch of a backfill over part of the history.
RANGE = ((1993, 3), (1997, 10))


def _scan_queries() -> dict[str, Query]:
    def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
        return stored.bronze_table(spark, sf_dir).read().drop(*_CLOCKS)

    def rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
        """A first write, a replay of one of its months, and an empty write, which is skipped."""
        rows = layers.bronze_trips(spark, sf_dir)
        table = VersionedTable(spark, fresh_dir(configure(spark), "rewritten"))
        table.commit(rows)
        month = [(SCAN_YEAR, SCAN_MONTH)]
        table.commit(pruning.scan_month(table.read(), *month[0]), replace=month, laid_out=True)
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            table.commit(rows.where("source_year < 0"), replace=month)
        return table.read().drop(*_CLOCKS).withColumn("version", F.lit(table.latest_version()))

    return {
        "write_roundtrip": rewritten,
        "scan_full": bronze,
        "scan_month": lambda s, d: pruning.scan_month(bronze(s, d), SCAN_YEAR, SCAN_MONTH),
        "scan_year": lambda s, d: pruning.scan_year(bronze(s, d), SCAN_YEAR),
        "pruning_rows": lambda s, d: pruning.pruning_rows(bronze(s, d), SCAN_YEAR, SCAN_MONTH),
        # Files and bytes depend on how the rows were written; partitions do not.
        "pruning_scans": lambda s, d: pruning.pruning_scans(bronze(s, d), SCAN_YEAR, SCAN_MONTH).drop("files", "bytes"),
    }


def _batch_queries() -> dict[str, Query]:
    def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tables.trips(spark, sf_dir)

    def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = trips(spark, sf_dir)
        return batches.backfill_summary(batches.months_spanned(rows, True), rows, trip_rules())

    return {
        "batch_calendar": lambda s, d: batches.calendar_with_rows(
            batches.months_spanned(trips(s, d), True), trips(s, d)
        ),
        "batch_range": lambda s, d: batches.calendar_with_rows(
            batches.BatchRange(*RANGE, earliest_year=RANGE[0][0]).calendar(s), trips(s, d)
        ),
        "missing_batches": lambda s, d: batches.missing_batches(
            batches.months_spanned(trips(s, d), True), trips(s, d)
        ),
        "backfill_summary": backfill,
        "backfill_totals": lambda s, d: batches.summary_totals(backfill(s, d)),
    }


def _typed_days(rows: DataFrame) -> DataFrame:
    """Text columns of station days as dates and numbers."""
    numbers = ("LATITUDE", "LONGITUDE", "ELEVATION", *WEATHER_METRICS)
    typed = {c: F.col(c).try_cast("double") for c in numbers if c in rows.columns}
    return rows.withColumns({"DATE": F.col("DATE").try_cast("date"), **typed})


def _weather_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives that land as files; the days of some stations have a column of their own."""
    root = fresh_dir(configure(spark), "raw-archives")
    days = tables.weather(spark, sf_dir).drop("source_month")
    wider = days.withColumn("NETWORK", F.concat(F.lit("net "), F.col("STATION")))
    odd = F.col("STATION") < "S010"
    sample_files.land_archives(days.where(~odd), f"{root}/usual")
    sample_files.land_archives(wider.where(odd), f"{root}/wider")
    return _read_days(audit_weather(station_files.read_archives(spark, root)))


def _read_days(bronze: DataFrame) -> DataFrame:
    """Days read from archives, typed, without the attribute columns that the
    samples lack, and with the archive's year for its whole path."""
    file = F.regexp_replace("source_file", r"^.*/(\d{4})[^/]*$", "raw/weather/$1.tar.gz")
    typed = _typed_days(bronze.drop(*_CLOCKS)).withColumn("source_file", file)
    return typed.drop(*[c for c in bronze.columns if c.endswith("_ATTRIBUTES")])


def _catch_up_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, each with new archives of all years; the second replaces them whole."""
    root, checkpoint = fresh_dir(configure(spark), "raw-archives"), fresh_dir(spark, "catchup-state")
    table = VersionedTable(spark, fresh_dir(spark, "catchup-weather"))
    days = tables.weather(spark, sf_dir).drop("source_month")
    for landing, where in (("first", "STATION < 'S030'"), ("deep/second", "STATION >= 'S030'")):
        sample_files.land_archives(days.where(where), f"{root}/{landing}")
        catch_up_weather(spark, root, table, checkpoint)
    return _read_days(table.read()).drop("bad_record")


def _undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per batch after 1995 was replaced; days without a readable date have no month."""
    return stored.undated_days(spark, sf_dir).read().groupBy("source_year", "source_month").agg(
        F.count("*").alias("rows"), F.count(F.col("DATE").try_cast("date")).alias("dated")
    )


def _weather_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sample_files.station_csvs(configure(spark), sf_dir)
    return _typed_days(station_files.with_year(station_files.read_station_files(spark, root))).drop("source_file")


def _month_file_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = sample_files.month_files(configure(spark), sf_dir)
    return _batch_file(audit_trips(month_files.read_months(spark, root)).drop(*_CLOCKS))


def _batch_file(trips: DataFrame) -> DataFrame:
    """The batch that a row's file lies in, for the file's whole path."""
    folder = F.substring_index(F.substring_index("source_file", "/", -2), "/", 1)
    return trips.withColumn("source_file", F.concat(F.lit("raw/taxi/"), F.substring_index(folder, "batch=", -1)))


def _zone_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(configure(spark), "zones")
    zone_lookup.write_zones(tables.zones(spark, sf_dir), path)
    return zone_lookup.read_zones(spark, path)


def _catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs: batches up to 1997 land before the first, the rest after it."""
    configure(spark)
    root, checkpoint = fresh_dir(spark, "raw-trips"), fresh_dir(spark, "catchup-state")
    table = VersionedTable(spark, fresh_dir(spark, "catchup-trips"))
    rows = tables.trips(spark, sf_dir)
    for landing in ("source_year <= 1997", "source_year > 1997"):
        month_files.write_months(rows.where(landing), root)
        catch_up_trips(spark, root, table, checkpoint)
    return _batch_file(table.read().drop(*_CLOCKS))


def _ingest_queries() -> dict[str, Query]:
    return {
        "ingest_month_files": _month_file_ingest,
        "bronze_weather_archive": _weather_archive,
        "weather_union_by_name": _weather_union,
        "zone_lookup_file": _zone_file,
        "catchup_ingest": _catch_up,
        "catchup_weather": _catch_up_weather,
        "undated_days": _undated,
    }


_MONTHLY_DIGEST = (
    "count(*) AS rows",
    "sum(CAST(trip_distance * 2 AS BIGINT)) AS half_miles",
    "count(passenger_count) AS with_passengers",
)


def _digest(df: DataFrame, *more: str) -> DataFrame:
    return df.groupBy("source_year", "source_month").agg(
        *[F.expr(e) for e in (*_MONTHLY_DIGEST, *more)]
    )


def _version_queries() -> dict[str, Query]:
    revised = stored.revised_trips

    def at_time(spark: SparkSession, sf_dir: str) -> DataFrame:
        table = revised(spark, sf_dir)
        moment = table.history().where("version = 1").first().ts
        return _digest(table.as_of_time(moment))

    def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _digest(
            revised(spark, sf_dir).read(),
            "count(airport_fee) AS with_fee",
            "sum(CAST(airport_fee * 4 AS BIGINT)) AS fee_quarters",
        )

    return {
        "replace_month": lambda s, d: _digest(revised(s, d).as_of(1)),
        "replace_year": lambda s, d: _digest(revised(s, d).as_of(2)),
        "schema_merge": merged,
        "asof_version": lambda s, d: revised(s, d).as_of(2).drop(*_CLOCKS),
        "asof_timestamp": at_time,
        "rows_per_version": lambda s, d: revised(s, d).rows_per_version(),
        "table_history": lambda s, d: revised(s, d).history(3).drop("ts"),
        "schema_history": lambda s, d: revised(s, d)
        .schema_history()
        .drop("position")
        .join(revised(s, d).rows_per_version(), "version"),
        "layer_drift": lambda s, d: filled_changes(layers.bronze_trips(s, d), layers.staged_trips(s, d)),
        "schema_diff": lambda s, d: revised(s, d)
        .schema_drift()
        .join(revised(s, d).rows_per_version(), "version"),
    }


def _suites(spark: SparkSession, sf_dir: str, kinds: tuple[str, ...] | None, *names: str) -> DataFrame:
    """Report of the named suites, or of only some kinds of their checks."""

    def stored_silver_days(s: SparkSession, d: str) -> DataFrame:
        return stored.silver_weather_table(s, d).read()

    suites = {
        "taxi/bronze": (layers.bronze_trips, quality.trip_bronze_suite(), quality.MONTHLY),
        "taxi/silver": (layers.clean_trips, quality.trip_silver_suite(), quality.MONTHLY),
        "weather/bronze": (layers.bronze_weather, quality.weather_bronze_suite(), quality.YEARLY),
        "weather/silver": (stored_silver_days, quality.weather_silver_suite(), quality.YEARLY),
    }
    result = None
    for name in names:
        source, checks, batch = suites[name]
        checks = [c for c in checks if kinds is None or c.kind in kinds]
        domain, layer = name.split("/")
        report = quality.evaluate(source(spark, sf_dir), checks, batch, domain, layer)
        result = report if result is None else result.unionAll(report)
    return result


def _checks(kind: str, *names: str) -> Query:
    return lambda spark, sf_dir: _suites(spark, sf_dir, (kind,), *names)


_TRIP_SUITES = ("taxi/bronze", "taxi/silver")
_WEATHER_SUITES = ("weather/bronze", "weather/silver")


def _stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(configure(spark), "reports")
    quality.write_report(_suites(spark, sf_dir, None, *_TRIP_SUITES, *_WEATHER_SUITES), path)
    return quality.read_report(spark, path)


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze verdicts from the stored report, and the rows that go on to Silver."""
    bronze = stored.bronze_table(spark, sf_dir).read()
    path = fresh_dir(spark, "gate-report")
    report = quality.evaluate(
        bronze, quality.trip_bronze_suite(stored.GATE_ROWS), quality.MONTHLY, "taxi", "bronze"
    )
    quality.write_report(report, path)
    verdict = quality.verdicts(quality.read_report(spark, path))
    admitted = (
        quality.admit(bronze, verdict, quality.MONTHLY)
        .groupBy(F.expr(quality.batch_label(quality.MONTHLY)).alias("batch"))
        .agg(F.count("*").alias("admitted"))
    )
    return verdict.join(admitted, "batch", "left").na.fill(0, ["admitted"])


def _quality_queries() -> dict[str, Query]:
    return {
        "dq_row_count": _checks(quality.ROW_COUNT, *_TRIP_SUITES, *_WEATHER_SUITES),
        "dq_columns_exist": _checks(quality.EXISTS, "taxi/bronze", "weather/bronze"),
        "dq_not_null": _checks(quality.NOT_NULL, *_TRIP_SUITES),
        "dq_between": _checks(quality.BETWEEN, "taxi/silver", "weather/silver"),
        "dq_pair_greater": _checks(quality.PAIR_GREATER, "taxi/silver"),
        "dq_in_set": _checks(quality.IN_SET, "taxi/silver", "weather/silver"),
        "dq_unique_count": _checks(quality.UNIQUE_COUNT, "weather/silver"),
        "dq_compound_unique": _checks(quality.COMPOUND_UNIQUE, "weather/silver"),
        "dq_suite_trips": lambda s, d: _suites(s, d, None, *_TRIP_SUITES),
        "dq_suite_weather": lambda s, d: _suites(s, d, None, *_WEATHER_SUITES),
        "dq_report": _stored_report,
        "dq_gate": _gate,
    }


def _top_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All zone pairs, best first by trips; the other columns settle ties."""
    model = gold.TRIP_MODELS["zone_performance"]
    zones = model.build(layers.zoned_trips(spark, sf_dir))
    ties = [F.asc_nulls_last(k) for k in model.keys]
    return zones.orderBy(F.desc("total_trips"), *ties)


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    flows = (stored.trip_pipeline(spark, sf_dir), stored.weather_pipeline(spark, sf_dir))
    served = {m: flow.gold(m) for flow in flows for m in flow.models()}
    serving.register(spark, {m: t for m, t in served.items() if t.exists()})
    return serving.table_rows(spark)


def _served(model: str) -> Query:
    """All rows of a served table, as a SQL client asks for them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _catalog(spark, sf_dir)
        return spark.sql(f"SELECT * FROM gold.{serving.SERVED_NAMES[model]}")

    return run


def _stored_gold(model: str) -> Query:
    """A Gold table as the pipeline stored it."""
    flow = stored.trip_pipeline if model in gold.TRIP_MODELS else stored.weather_pipeline
    return lambda spark, sf_dir: flow(spark, sf_dir).gold(model).read().drop(*_CLOCKS)


def _pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts of the stopped run: which checks of which batch failed."""
    flow = stored.weather_pipeline(spark, sf_dir, once=False)
    return (
        quality.read_report(spark, flow.report_path)
        .where("NOT success")
        .select("domain", "layer", "batch", "expectation", "column", "element_count", "unexpected_count")
    )


def _pipeline_queries() -> dict[str, Query]:
    return {
        "top_zones": _top_zones,
        "pipeline_drops": lambda s, d: stored.trip_pipeline(s, d).drops().drop("step"),
        "pipeline_trips": lambda s, d: stored.trip_pipeline(s, d).summary(),
        "pipeline_weather": lambda s, d: stored.weather_pipeline(s, d).summary(),
        "pipeline_weather_stopped": lambda s, d: stored.weather_pipeline(s, d, once=False).summary(),
        "dq_pipeline_weather": _pipeline_report,
        **{f"stored_{model}": _stored_gold(model) for model in (*gold.TRIP_MODELS, *gold.WEATHER_MODELS)},
        "catalog_tables": _catalog,
        "catalog_daily_summary": _served("daily_summary"),
        "catalog_monthly_climate": _served("monthly_climate"),
    }


def queries() -> dict[str, Query]:
    return {
        **_layer_queries(),
        **_batch_queries(),
        **_scan_queries(),
        **_gold_queries(),
        **_dashboard_queries(),
        **_quality_queries(),
        **_version_queries(),
        **_ingest_queries(),
        **_pipeline_queries(),
    }
