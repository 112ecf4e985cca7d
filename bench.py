"""Headline queries on stored layers; prints one JSON line.

The Bronze and Silver tables are written first, as the pipeline would, with the
shipped settings; then every query is run a few times to warm up, and timed over
five further runs (the median). Writes and the ingest of files count in the
total, once each and without a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from tierwise.operators import gold, pruning, quality, rules
from tierwise.operators.bronze import audit_weather
from tierwise.operators.dimension import trips_with_zones
from tierwise.operators.silver import silver_trips, silver_weather, stage_trips, stage_weather
from tierwise.operators.versions import VersionedTable
from tierwise.plans import layers, sample_files, stored
from tierwise.session import fresh_dir, local_session
from tierwise.sources import tables
from tierwise.streaming.catchup import catch_up_trips

WARM_UPS, RUNS = 3, 5


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], object]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    seconds["write_bronze_trips"] = timed(lambda: stored.bronze_table(spark, sf_dir))
    seconds["write_silver_trips"] = timed(lambda: stored.silver_table(spark, sf_dir))
    seconds["write_silver_weather"] = timed(lambda: stored.silver_weather_table(spark, sf_dir))
    bronze_days = VersionedTable(spark, fresh_dir(spark, "bronze-weather"))
    seconds["write_bronze_weather"] = timed(
        lambda: bronze_days.commit(layers.bronze_weather(spark, sf_dir))
    )
    bronze = stored.bronze_table(spark, sf_dir)
    trips, cleaned = bronze.read(), stored.silver_table(spark, sf_dir).read()
    days, clean_days = bronze_days.read(), stored.silver_weather_table(spark, sf_dir).read()
    zones = tables.zones(spark, sf_dir)
    staged, staged_days = stage_trips(cleaned), stage_weather(clean_days)
    models = gold.TRIP_MODELS

    def suites(*parts) -> DataFrame:
        result = None
        for df, checks, batch, domain, layer in parts:
            report = quality.evaluate(df, checks, batch, domain, layer)
            result = report if result is None else result.unionAll(report)
        return result

    queries: dict[str, Callable[[], DataFrame]] = {
        "scan_full": lambda: cleaned,
        "scan_full_bronze": lambda: trips,
        "scan_month": lambda: pruning.scan_month(cleaned, 1996, 6),
        "scan_year": lambda: pruning.scan_year(cleaned, 1996),
        "pruning_rows": lambda: pruning.pruning_rows(cleaned, 1996, 6),
        "silver_trips": lambda: silver_trips(trips),
        "silver_weather": lambda: silver_weather(audit_weather(days)),
        "drop_report": lambda: rules.drop_report(trips, rules.trip_rules()),
        "trips_with_zones": lambda: trips_with_zones(staged, zones),
        "gold_weekday_summary": lambda: models["daily_summary"].build(staged),
        "gold_hourly_summary": lambda: models["hourly_summary"].build(staged),
        "gold_date_summary": lambda: models["individual_day_summary"].build(staged),
        "gold_payment_summary": lambda: models["payment_summary"].build(staged),
        "gold_zone_performance": lambda: models["zone_performance"].build(
            trips_with_zones(staged, zones)
        ),
        "gold_trips_one_pass": lambda: gold.trip_models_in_one_pass(trips_with_zones(staged, zones)),
        "gold_daily_climate": lambda: gold.daily_climate(staged_days),
        "gold_monthly_climate": lambda: gold.monthly_climate(staged_days),
        "gold_station_metrics": lambda: gold.station_metrics(staged_days),
        "gold_station_longterm": lambda: gold.station_longterm(staged_days),
        "dq_suite_trips": lambda: suites(
            (trips, quality.trip_bronze_suite(), quality.MONTHLY, "taxi", "bronze"),
            (cleaned, quality.trip_silver_suite(), quality.MONTHLY, "taxi", "silver"),
        ),
        "dq_suite_weather": lambda: suites(
            (days, quality.weather_bronze_suite(), quality.YEARLY, "weather", "bronze"),
            (clean_days, quality.weather_silver_suite(), quality.YEARLY, "weather", "silver"),
        ),
        "asof_version": lambda: bronze.as_of(0),
    }
    def ingest() -> None:
        """Batches that have landed as files, caught up with."""
        caught = VersionedTable(spark, fresh_dir(spark, "bench-caught"))
        catch_up_trips(spark, sample_files.month_files(spark, sf_dir), caught, fresh_dir(spark, "bench-state"))

    def replace_month() -> None:
        bronze.commit(pruning.scan_month(trips, 1996, 6), replace=[(1996, 6)])

    seconds["ingest_month_files"] = timed(ingest)
    seconds["replace_month"] = timed(replace_month)
    seconds["pipeline_trips"] = timed(lambda: stored.trip_pipeline(spark, sf_dir))
    total = sum(seconds.values())
    for name, plan in queries.items():
        for _ in range(WARM_UPS):
            run(plan())
        seconds[name] = statistics.median(timed(lambda: run(plan())) for _ in range(RUNS))
        total += seconds[name]
    pruned = pruning.compare(lambda: cleaned, queries["scan_month"])
    rows = {"scan_full": cleaned.count(), "scan_year": queries["scan_year"]().count(), "scan_full_bronze": trips.count()}
    print(
        json.dumps(
            {
                "metric": "total time of writes, ingest and the headline queries on stored layers",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "pruning": {name: round(value, 3) for name, value in pruned.items()},
                "scans": {name: pruning.scan_figures(plan) for name, plan in (("full", cleaned), ("month", queries["scan_month"]()))},
                "rows": rows,
                "rows_per_sec": {name: round(n / seconds[name]) for name, n in rows.items()},
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    sys.exit(main())
