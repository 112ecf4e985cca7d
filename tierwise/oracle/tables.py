"""Oracle statements of the batch, scan, version, file and pipeline queries."""

from __future__ import annotations

from tierwise.oracle.relations import TRIP_RULES, WEATHER_ONCE, using
from tierwise.oracle.statements import DAILY_CLIMATE, MONTHLY_CLIMATE, STATION_METRICS, trip_model

_WHOLE_YEARS = """
    SELECT CAST(year(m) AS SMALLINT) AS source_year, CAST(month(m) AS TINYINT) AS source_month
    FROM (SELECT unnest(generate_series(
        (SELECT make_date(CAST(min(source_year) AS INTEGER), 1, 1) FROM trips),
        (SELECT make_date(CAST(max(source_year) AS INTEGER), 12, 1) FROM trips),
        INTERVAL 1 MONTH)) AS m) months"""

_KEPT = " AND ".join(f"({c})" for c in TRIP_RULES.values())

_BACKFILL = f"""
    SELECT printf('%d-%02d', c.source_year, c.source_month) AS batch,
        coalesce(bronze_rows, 0) AS bronze_rows, coalesce(silver_rows, 0) AS silver_rows,
        coalesce(bronze_rows - silver_rows, 0) AS dropped_rows,
        CASE WHEN silver_rows > 0 THEN 'success' ELSE 'failed' END AS status
    FROM calendar c LEFT JOIN (
        SELECT source_year, source_month, count(*) AS bronze_rows,
            count(*) FILTER (WHERE {_KEPT}) AS silver_rows
        FROM trips GROUP BY source_year, source_month
    ) t ON c.source_year = t.source_year AND c.source_month = t.source_month"""


def _batches(span: tuple[tuple[int, int], tuple[int, int]]) -> dict[str, str]:
    also = {"calendar": _WHOLE_YEARS}
    totals = """
SELECT count(*) FILTER (WHERE status = 'success') AS successful,
    count(*) FILTER (WHERE status = 'failed') AS failed,
    coalesce(string_agg(batch, ', ' ORDER BY batch) FILTER (WHERE status = 'failed'), '') AS failed_batches
FROM backfill"""
    return {
        "batch_calendar": using(
            "trips",
            also=also,
            then="""
SELECT c.source_year, c.source_month, count(t.source_year) AS "rows", count(t.source_year) > 0 AS landed
FROM calendar c LEFT JOIN trips t USING (source_year, source_month)
GROUP BY c.source_year, c.source_month""",
        ),
        "batch_range": using(
            "trips",
            then=f"""
SELECT CAST(year(m) AS SMALLINT) AS source_year, CAST(month(m) AS TINYINT) AS source_month,
    count(t.source_year) AS "rows", count(t.source_year) > 0 AS landed
FROM (SELECT unnest(generate_series(DATE '{span[0][0]}-{span[0][1]:02d}-01', DATE '{span[1][0]}-{span[1][1]:02d}-01',
          INTERVAL 1 MONTH)) AS m) months
LEFT JOIN trips t ON t.source_year = year(m) AND t.source_month = month(m)
GROUP BY m""",
        ),
        "missing_batches": using(
            "trips",
            also=also,
            then="SELECT * FROM calendar EXCEPT SELECT source_year, source_month FROM trips",
        ),
        "backfill_summary": using("trips", also=also, then=_BACKFILL),
        "backfill_totals": using("trips", also={**also, "backfill": _BACKFILL}, then=totals),
    }


def _scans(year: int, month: int) -> dict[str, str]:
    wanted = f"source_year = {year} AND source_month = {month}"
    bronze = "SELECT * FROM bronze_trips"
    return {
        "write_roundtrip": using("bronze_trips", then="SELECT *, 1 AS version FROM bronze_trips"),
        "scan_full": using("bronze_trips", then=bronze),
        "scan_month": using("bronze_trips", then=f"{bronze} WHERE {wanted}"),
        "scan_year": using("bronze_trips", then=f"{bronze} WHERE source_year = {year}"),
        "pruning_rows": using(
            "bronze_trips",
            then=f"""
SELECT count(*) AS rows_full, count(*) FILTER (WHERE {wanted}) AS rows_read,
    count(*) FILTER (WHERE NOT ({wanted})) AS rows_skipped,
    CAST(count(*) FILTER (WHERE {wanted}) AS DOUBLE) * 100 / nullif(CAST(count(*) AS DOUBLE), 0) AS read_pct
FROM bronze_trips""",
        ),
        "pruning_scans": using(
            "bronze_trips",
            then=f"""
SELECT 'full' AS "read", count(*) AS "rows", count(DISTINCT (source_year, source_month)) AS partitions FROM bronze_trips
UNION ALL
SELECT 'month', count(*), count(DISTINCT (source_year, source_month)) FROM bronze_trips WHERE {wanted}""",
        ),
    }


# The states of the revised table, by version.
_JUNE = "source_year = 1996 AND source_month = 6"
_MARCH = "source_year = 1997 AND source_month = 3"
_JANUARY = "source_year = 1998 AND source_month = 1"
_REVISED = {
    0: "SELECT * EXCLUDE (airport_fee) FROM bronze_trips",
    1: f"SELECT * EXCLUDE (airport_fee) REPLACE (CASE WHEN {_JUNE} THEN trip_distance * 2"
    " ELSE trip_distance END AS trip_distance) FROM bronze_trips",
    4: f"SELECT * REPLACE (CASE WHEN ({_JUNE}) OR ({_JANUARY}) THEN airport_fee END AS airport_fee)"
    f" FROM bronze_trips WHERE NOT ({_MARCH})",
}
_REVISED[2] = f"SELECT * FROM ({_REVISED[1]}) v1 WHERE NOT ({_MARCH})"

_DIGEST = """
SELECT source_year, source_month, count(*) AS "rows",
    CAST(sum(CAST(trip_distance * 2 AS BIGINT)) AS BIGINT) AS half_miles,
    count(passenger_count) AS with_passengers{more}
FROM ({state}) t GROUP BY source_year, source_month"""

_ROWS = f"""
    SELECT version, CASE WHEN version < 2 THEN n ELSE n - march END AS "rows"
    FROM (SELECT count(*) AS n, count(*) FILTER (WHERE {_MARCH}) AS march FROM trips) t,
        (VALUES (0), (1), (2), (3), (4)) v(version)"""

# The first schema of the revised table.
_COLUMNS = {
    "VendorID": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "bigint",
    "store_and_fwd_flag": "string",
    "PULocationID": "bigint",
    "DOLocationID": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "source_year": "smallint",
    "source_month": "tinyint",
    "ingested_at": "timestamp",
    "source_file": "string",
}


# Columns that differ between raw and staged trips, with their types
# on both sides. The clocks, which have a value in every row, are no columns here.
_DRIFT = {
    "DOLocationID": ("bigint", None), "PULocationID": ("bigint", None), "RatecodeID": ("bigint", None),
    "VendorID": ("bigint", None), "bronze_ingested_at": (None, "timestamp"), "day_name": (None, "string"),
    "dropoff_datetime": (None, "timestamp_ntz"), "dropoff_location_id": (None, "int"), "fare_amount": ("double", "float"),
    "ingested_at": ("timestamp", None), "is_weekend": (None, "boolean"), "passenger_count": ("double", "smallint"),
    "payment_method": (None, "string"), "payment_type": ("bigint", "smallint"), "pickup_date": (None, "date"),
    "pickup_datetime": (None, "timestamp_ntz"), "pickup_day_of_week": (None, "smallint"), "pickup_hour": (None, "smallint"),
    "pickup_location_id": (None, "int"), "rate_code_id": (None, "bigint"), "silver_processed_at": (None, "timestamp"),
    "tpep_dropoff_datetime": ("timestamp_ntz", None), "tpep_pickup_datetime": ("timestamp_ntz", None),
    "trip_distance": ("double", "float"), "trip_duration_minutes": (None, "bigint"), "trip_speed_mph": (None, "float"),
    "vendor_id": (None, "bigint"),
}
_CLOCK_COLUMNS = ("bronze_ingested_at", "ingested_at", "silver_processed_at")


def _layer_drift() -> str:
    def filled(table: str, name: str, type_name: str | None) -> str:
        if type_name is None:
            return "CAST(NULL AS BIGINT)"
        return f"(SELECT count({'*' if name in _CLOCK_COLUMNS else name}) FROM {table})"

    def text(value: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

    lines = []
    for name, (old, new) in _DRIFT.items():
        change = "ADDED" if old is None else "REMOVED" if new is None else "CHANGED"
        lines.append(
            f"SELECT '{name}' AS name, {text(old)} AS old_type, {text(new)} AS new_type, '{change}' AS change,"
            f" {filled('bronze_trips', name, old)} AS old_filled, {filled('staged_trips', name, new)} AS new_filled"
        )
    return "\nUNION ALL\n".join(lines)


def _versions() -> dict[str, str]:
    def digest(version: int, more: str = "") -> str:
        return using("bronze_trips", then=_DIGEST.format(state=_REVISED[version], more=more))

    base = ", ".join(f"('{n}', '{t}')" for n, t in _COLUMNS.items())
    history = f"""
SELECT * FROM (
    SELECT 4 AS version, 'WRITE' AS operation,
        'source_year = 1996 AND source_month = 6 OR source_year = 1998 AND source_month = 1' AS predicate,
        count(*) FILTER (WHERE ({_JUNE}) OR ({_JANUARY})) AS "rows" FROM trips
    UNION ALL SELECT 3, 'WRITE', 'source_year = 1998 AND source_month = 1',
        count(*) FILTER (WHERE {_JANUARY}) FROM trips
    UNION ALL SELECT 2, 'WRITE', 'source_year = 1997',
        count(*) FILTER (WHERE source_year = 1997 AND source_month != 3) FROM trips) h"""
    return {
        "replace_month": digest(1),
        "replace_year": digest(2),
        "asof_timestamp": digest(1),
        "schema_merge": digest(
            4,
            ', count(airport_fee) AS with_fee,'
            " CAST(sum(CAST(airport_fee * 4 AS BIGINT)) AS BIGINT) AS fee_quarters",
        ),
        "asof_version": using("bronze_trips", then=_REVISED[2]),
        "rows_per_version": using("trips", then=_ROWS),
        "table_history": using("trips", then=history),
        "schema_history": using(
            "trips",
            also={"per_version": _ROWS},
            then=f"""
SELECT version, name, type, "rows" FROM per_version, (VALUES {base}) c(name, type)
UNION ALL SELECT version, 'airport_fee', 'double', "rows" FROM per_version WHERE version >= 3""",
        ),
        "layer_drift": using("staged_trips", then=_layer_drift()),
        "schema_diff": using(
            "trips",
            also={"per_version": _ROWS},
            then="""
SELECT version, 'airport_fee' AS name, CAST(NULL AS VARCHAR) AS old_type, 'double' AS new_type,
    'ADDED' AS change, "rows"
FROM per_version WHERE version >= 3""",
        ),
    }


def _files() -> dict[str, str]:
    return {
        "ingest_month_files": using(
            "bronze_trips",
            then="SELECT * REPLACE (CASE WHEN source_year > 1997 THEN airport_fee END AS airport_fee)"
            " FROM bronze_trips",
        ),
        "catchup_ingest": using("bronze_trips", then="SELECT * FROM bronze_trips"),
        "bronze_weather_archive": using(
            "bronze_weather",
            then="""
SELECT *, CASE WHEN "STATION" < 'S010' THEN 'net ' || "STATION" END AS "NETWORK",
    CAST(NULL AS VARCHAR) AS bad_record FROM bronze_weather""",
        ),
        "catchup_weather": using("bronze_weather", then="SELECT * FROM bronze_weather"),
        "undated_days": using(
            "weather",
            then="""
SELECT source_year, CASE WHEN undated THEN NULL ELSE source_month END AS source_month,
    count(*) AS "rows", count(*) FILTER (WHERE NOT undated) AS dated
FROM (SELECT *, "STATION" IN ('S007', 'S008') AND "TEMP" > 50 AS undated FROM weather) w
WHERE NOT (undated AND source_year = 1995)
GROUP BY 1, 2""",
        ),
        "weather_union_by_name": using(
            "weather",
            then="""
SELECT * EXCLUDE (source_month)
    REPLACE (CASE WHEN CAST(substr("STATION", 2, 3) AS INTEGER) % 3 != 1 THEN "SNDP" END AS "SNDP"),
    CASE WHEN CAST(substr("STATION", 2, 3) AS INTEGER) % 3 = 2 THEN 'net ' || "STATION" END AS "NETWORK",
    CAST(NULL AS VARCHAR) AS bad_record
FROM weather""",
        ),
        "zone_lookup_file": using("zones", then="SELECT * FROM zones"),
    }


_TRIP_MODEL_KEYS = {
    "daily_summary": "source_year, source_month, pickup_day_of_week",
    "hourly_summary": "source_year, source_month, pickup_hour",
    "individual_day_summary": "source_year, source_month, pickup_date",
    "payment_summary": "source_year, source_month, payment_type",
    "zone_performance": "source_year, source_month, pickup_borough, pickup_zone, pickup_service_zone,"
    " dropoff_borough, dropoff_zone",
}
_WEATHER_MODEL_KEYS = {
    "monthly_climate": "station, station_name, latitude, longitude, elevation, source_year, source_month",
    "station_metrics": "station, station_name, latitude, longitude, elevation, source_year, source_month",
}


def _layer(domain: str, table: str, source: str) -> str:
    return (
        f"SELECT '{domain}' AS domain, '{table}' AS \"table\","
        f" count(DISTINCT (source_year, source_month)) AS partitions, count(*) AS \"rows\" FROM {source}"
    )


def _models(domain: str, keys: dict[str, str], source: str) -> list[str]:
    return [
        _layer(domain, f"gold_{name}", f"(SELECT DISTINCT {k} FROM {source}) m")
        for name, k in keys.items()
    ]


def _pipelines(low: int) -> dict[str, str]:
    month = "source_year, source_month"
    trips_also = {
        "bronze_ok": f"SELECT {month} FROM bronze_trips GROUP BY {month} HAVING count(*) >= {low}",
        "silver_rows": f"SELECT t.* FROM trips_with_zones t JOIN bronze_ok USING ({month})",
        "silver_ok": f"SELECT {month} FROM silver_rows GROUP BY {month} HAVING count(*) >= {low}",
        "gold_rows": f"SELECT t.* FROM silver_rows t JOIN silver_ok USING ({month})",
    }
    weather_also = {
        "bronze_ok": f"SELECT source_year FROM weather GROUP BY source_year HAVING count(*) >= {low}",
        "silver_rows": "SELECT w.* FROM staged_weather w JOIN bronze_ok USING (source_year)",
        "silver_ok": "SELECT source_year FROM silver_rows GROUP BY source_year"
        f" HAVING count(*) >= {low} AND count(DISTINCT source_month) = 12"
        " AND count(*) = count(DISTINCT (station, date))",
        "gold_rows": "SELECT w.* FROM silver_rows w JOIN silver_ok USING (source_year)",
    }
    trips = [
        _layer("taxi", "bronze", "bronze_trips"),
        _layer("taxi", "silver", "silver_rows"),
        *_models("taxi", _TRIP_MODEL_KEYS, "gold_rows"),
    ]
    weather = [
        _layer("weather", "bronze", "bronze_weather"),
        _layer("weather", "silver", "silver_rows"),
        _layer("weather", "gold_daily_climate", "gold_rows"),
        *_models("weather", _WEATHER_MODEL_KEYS, "gold_rows"),
    ]
    trip_text = using(
        "bronze_trips", "trips_with_zones", also=trips_also, then="\nUNION ALL\n".join(trips)
    )
    once = {"weather": WEATHER_ONCE}
    all_weather = "\nUNION ALL\n".join(weather)
    weather_text = using("staged_weather", also=weather_also, then=all_weather, instead=once)
    served = f"""
SELECT domain || substr("table", 5) AS table_name, 'gold' AS table_schema, "rows"
FROM (SELECT * FROM ({trip_text}) a UNION ALL SELECT * FROM ({weather_text}) b) t
WHERE "table" LIKE 'gold%'"""
    stored = {}
    for name in _TRIP_MODEL_KEYS:
        body, helpers = trip_model(name, peak=name != "hourly_summary", payments=name != "payment_summary")
        helpers = {k: v.replace("trips_with_zones", "gold_rows") for k, v in helpers.items()}
        body = body.replace("FROM trips_with_zones", "FROM gold_rows")
        stored[f"stored_{name}"] = using(
            "bronze_trips", "trips_with_zones", also={**trips_also, **helpers}, then=body
        )
    models = {"daily_climate": DAILY_CLIMATE, "monthly_climate": MONTHLY_CLIMATE, "station_metrics": STATION_METRICS}
    for name, body in models.items():
        body = body.replace("FROM staged_weather", "FROM gold_rows")
        stored[f"stored_{name}"] = using("staged_weather", also=weather_also, then=body, instead=once)
    kept = " AND ".join(f"({c})" for c in TRIP_RULES.values())
    failed = ", ".join(
        f"count(*) FILTER (WHERE coalesce({c}, FALSE) = FALSE) AS failed_{name}" for name, c in TRIP_RULES.items()
    )
    drops = f"""
SELECT 'taxi' AS domain, count(*) AS rows_read, count(*) FILTER (WHERE {kept}) AS rows_kept,
    count(*) - count(*) FILTER (WHERE {kept}) AS rows_dropped, {failed}
FROM (SELECT t.* FROM bronze_trips t JOIN bronze_ok USING ({month})) t"""
    return {
        "pipeline_drops": using("bronze_trips", also={"bronze_ok": trips_also["bronze_ok"]}, then=drops),
        "pipeline_trips": trip_text,
        "pipeline_weather": weather_text,
        "pipeline_weather_stopped": using("staged_weather", also=weather_also, then=all_weather),
        "catalog_tables": served,
        "catalog_daily_summary": stored["stored_daily_summary"],
        "catalog_monthly_climate": stored["stored_monthly_climate"],
        **stored,
    }


def _top_zones() -> str:
    body, also = trip_model("zone_performance")
    return using(
        "trips_with_zones",
        also=also,
        then=f"""
SELECT * FROM ({body}) z
ORDER BY total_trips DESC, pickup_borough ASC NULLS LAST, pickup_zone ASC NULLS LAST,
    pickup_service_zone ASC NULLS LAST, dropoff_borough ASC NULLS LAST, dropoff_zone ASC NULLS LAST,
    source_year, source_month""",
    )


def statements(
    scan: tuple[int, int], gate_rows: tuple[int, int], span: tuple[tuple[int, int], tuple[int, int]]
) -> dict[str, str]:
    return {
        **_batches(span),
        **_scans(*scan),
        **_versions(),
        **_files(),
        **_pipelines(gate_rows[0]),
        "top_zones": _top_zones(),
    }
