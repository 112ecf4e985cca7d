"""Data-quality suites, evaluated for all batches of a table at once.

A suite is a list of checks. It compiles to one grouped aggregation over the
table (plus one keyed count where a compound key must be unique), and the wide
result is unfolded into one report row per batch and check. Nothing but counts
leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwise.functions import count_where
from tierwise.schemas import AUDIT, PARTITION_KEYS, PARTITION_TYPES

MONTHLY = PARTITION_KEYS
YEARLY = ("source_year",)

# How a batch is named in reports: 2023_06 for a month, 2023 for a year.
_BATCH_LABEL = {
    MONTHLY: "concat(source_year, '_', lpad(source_month, 2, '0'))",
    YEARLY: "CAST(source_year AS STRING)",
}


def batch_label(keys: Sequence[str]) -> str:
    return _BATCH_LABEL[tuple(keys)]


@dataclass(frozen=True)
class Check:
    """One expectation. `kind` decides which of the other fields matter."""

    kind: str
    column: str | None = None
    mostly: float = 1.0
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    other: str | None = None
    columns: tuple[str, ...] = ()

    def needs(self) -> tuple[str, ...]:
        named = (self.column, self.other, *self.columns)
        return tuple(c for c in named if c is not None)

    def label(self) -> str | None:
        if self.kind == COMPOUND_UNIQUE:
            return ",".join(self.columns)
        if self.kind == PAIR_GREATER:
            return f"{self.column},{self.other}"
        return self.column


# Expectation names as they appear in reports.
ROW_COUNT = "expect_table_row_count_to_be_between"
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
PAIR_GREATER = "expect_column_pair_values_a_to_be_greater_than_b"
IN_SET = "expect_column_values_to_be_in_set"
UNIQUE_COUNT = "expect_column_unique_value_count_to_be_between"
COMPOUND_UNIQUE = "expect_compound_columns_to_be_unique"


def row_count(low: int, high: int) -> Check:
    return Check(ROW_COUNT, low=low, high=high)


def exist(columns: Sequence[str]) -> list[Check]:
    return [Check(EXISTS, c) for c in columns]


def not_null(columns: Sequence[str], mostly: float = 1.0) -> list[Check]:
    return [Check(NOT_NULL, c, mostly=mostly) for c in columns]


def between(column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check(BETWEEN, column, low=low, high=high)


def pair_greater(column: str, other: str) -> Check:
    return Check(PAIR_GREATER, column, other=other)


def in_set(column: str, values: Sequence) -> Check:
    return Check(IN_SET, column, values=tuple(values))


def unique_count(column: str, low: int, high: int) -> Check:
    return Check(UNIQUE_COUNT, column, low=low, high=high)


def compound_unique(columns: Sequence[str]) -> Check:
    return Check(COMPOUND_UNIQUE, columns=tuple(columns))


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return str(value).upper() if isinstance(value, bool) else str(value)


def _holds(check: Check) -> str:
    """Condition on a single row; null where the row is not judged."""
    if check.kind == BETWEEN:
        bounds = []
        if check.low is not None:
            bounds.append(f"`{check.column}` >= {check.low}")
        if check.high is not None:
            bounds.append(f"`{check.column}` <= {check.high}")
        return " AND ".join(bounds)
    if check.kind == IN_SET:
        return f"`{check.column}` IN ({', '.join(map(_literal, check.values))})"
    a, b = f"`{check.column}`", f"`{check.other}`"
    # A pair with one side missing is judged, and fails.
    return f"CASE WHEN {a} IS NOT NULL OR {b} IS NOT NULL THEN coalesce({a} > {b}, FALSE) END"


def _counters(i: int, check: Check) -> dict[str, str]:
    """Aggregates of one check: rows judged (`_p`), rows failing (`_u`)."""
    if check.kind == NOT_NULL:
        return {f"_u{i}": f"count(*) - count(`{check.column}`)"}
    if check.kind in (BETWEEN, IN_SET, PAIR_GREATER):
        if check.kind == PAIR_GREATER:
            judged = f"count(coalesce(`{check.column}`, `{check.other}`))"
        else:
            judged = f"count(`{check.column}`)"
        return {f"_p{i}": judged, f"_u{i}": count_where(f"NOT ({_holds(check)})")}
    if check.kind == UNIQUE_COUNT:
        return {f"_d{i}": f"count(DISTINCT `{check.column}`)"}
    return {}


_FIELDS = {
    "expectation": "STRING",
    "column": "STRING",
    "success": "BOOLEAN",
    "element_count": "BIGINT",
    "missing_count": "BIGINT",
    "unexpected_count": "BIGINT",
    "unexpected_pct": "DOUBLE",
    "observed": "STRING",
}


def _result(i: int, check: Check, known: set[str]) -> str:
    """The report fields of one check, from the counters of its batch."""
    name = check.label()
    fields = {
        "expectation": _literal(check.kind),
        "column": "NULL" if name is None else _literal(name),
        "success": "FALSE",
        "element_count": "_n",
        "missing_count": "NULL",
        "unexpected_count": "NULL",
        "unexpected_pct": "NULL",
        "observed": "NULL",
    }
    present = set(check.needs()) <= known
    if check.kind == EXISTS:
        fields["success"] = "TRUE" if present else "FALSE"
    elif not present:
        pass  # a check on a column that is not there cannot pass
    elif check.kind in (ROW_COUNT, UNIQUE_COUNT):
        value = "_n" if check.kind == ROW_COUNT else f"_d{i}"
        fields["success"] = f"{value} >= {check.low} AND {value} <= {check.high}"
        fields["observed"] = f"CAST({value} AS STRING)"
    else:
        judged = "_n" if check.kind == NOT_NULL else f"_p{i}"
        failing = f"_u{i}"
        fields["success"] = (
            f"{judged} = 0 OR ({judged} - {failing}) / nullif(CAST({judged} AS DOUBLE), 0D)"
            f" >= {check.mostly}D"
        )
        fields["missing_count"] = f"_n - {judged}"
        fields["unexpected_count"] = failing
        fields["unexpected_pct"] = (
            f"CAST({failing} AS DOUBLE) * 100 / nullif(CAST({judged} AS DOUBLE), 0D)"
        )
    text = ", ".join(f"'{k}', CAST({v} AS {_FIELDS[k]})" for k, v in fields.items())
    return f"named_struct({text})"


def _key_counts(df: DataFrame, batch: Sequence[str], i: int, check: Check) -> DataFrame:
    """Rows with a usable key, and rows whose key occurs more than once. The
    count per key combines map-side; a window would sort every row."""
    usable = " OR ".join(f"`{c}` IS NOT NULL" for c in check.columns)
    per_key = df.where(usable).groupBy(*batch, *check.columns).agg(F.count("*").alias("_k"))
    return per_key.groupBy(*batch).agg(
        F.expr("sum(_k)").alias(f"_p{i}"),
        F.expr("sum(CASE WHEN _k > 1 THEN _k ELSE 0 END)").alias(f"_u{i}"),
    )


def evaluate(
    df: DataFrame,
    checks: Sequence[Check],
    batch: Sequence[str],
    domain: str,
    layer: str,
    requested: DataFrame | None = None,
) -> DataFrame:
    """One report row per batch and check.

    `requested` lists the batches that must be reported; one that has no rows
    is judged as empty instead of being passed over. By default these are the
    batches found in the table.
    """
    known = set(df.columns)
    counters: dict[str, str] = {"_n": "count(*)"}
    for i, check in enumerate(checks):
        if set(check.needs()) <= known:
            counters.update(_counters(i, check))
    wide = df.groupBy(*batch).agg(*[F.expr(e).alias(name) for name, e in counters.items()])
    names = list(counters)
    for i, check in enumerate(checks):
        if check.kind == COMPOUND_UNIQUE and set(check.columns) <= known:
            wide = wide.join(_key_counts(df, batch, i, check), list(batch), "left")
            names += [f"_p{i}", f"_u{i}"]
    if requested is not None:
        wide = requested.select(*batch).join(wide, list(batch), "left")
    wide = wide.na.fill(0, names)
    results = ", ".join(_result(i, check, known) for i, check in enumerate(checks))
    return wide.selectExpr(
        f"'{domain}' AS domain",
        f"'{layer}' AS layer",
        f"{batch_label(batch)} AS batch",
        f"inline(array({results}))",
    )


def verdicts(report: DataFrame) -> DataFrame:
    """Per batch: checks passed, checks made, and whether all passed."""
    return report.groupBy("domain", "layer", "batch").agg(
        F.expr(count_where("success")).alias("passed"),
        F.count("*").alias("total"),
        F.expr("every(success)").alias("success"),
    )


def admit(df: DataFrame, verdict: DataFrame, batch: Sequence[str]) -> DataFrame:
    """Rows of the batches that passed; the next layer's input.

    Batches are matched by the partition columns, so that Spark reads only the
    partitions that go on.
    """
    parts = [
        F.element_at(F.split("batch", "_"), i + 1).cast(PARTITION_TYPES[key]).alias(key) for i, key in enumerate(batch)
    ]
    return df.join(verdict.where("success").select(*parts), list(batch), "left_semi")


def write_report(report: DataFrame, path: str) -> None:
    """JSON documents by domain, layer and batch. Re-validated batches replace
    their own documents and leave the others alone."""
    (
        report.hint("rebalance", "domain", "layer", "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("domain", "layer", "batch")
        .json(path)
    )


def read_report(spark, path: str) -> DataFrame:
    fields = ", ".join(f"`{k}` {v}" for k, v in _FIELDS.items())
    return spark.read.schema(f"{fields}, domain STRING, layer STRING, batch STRING").json(path)


# --- the four suites -----------------------------------------------------

# Column lists of the suites.
TRIP_BRONZE_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "RatecodeID",
    "store_and_fwd_flag",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "total_amount",
    "congestion_surcharge",
    *AUDIT,
)
TRIP_BRONZE_FILLED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "fare_amount",
    "trip_distance",
    *AUDIT,
)
TRIP_SILVER_COLUMNS = (
    "VendorID",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "payment_type",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "source_year",
    "source_month",
    "source_file",
    "ingested_at",
    "trip_duration_minutes",
    "pickup_day_of_week",
    "trip_speed_mph",
    "pickup_hour",
    "payment_method",
    "day_name",
    "is_weekend",
    "pickup_date",
    "processed_at",
)
TRIP_SILVER_FILLED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "trip_distance",
    "passenger_count",
    "payment_type",
    "trip_duration_minutes",
    "pickup_day_of_week",
    "pickup_hour",
    "payment_method",
    "day_name",
    "is_weekend",
    "pickup_date",
    "source_year",
    "source_month",
    "processed_at",
)
TRIP_SILVER_SPARSE = ("trip_speed_mph",)
PAYMENT_NAMES = ("Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Voided")
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

WEATHER_BRONZE_COLUMNS = (
    "STATION",
    "DATE",
    "DEWP",
    "DEWP_ATTRIBUTES",
    "WDSP",
    "WDSP_ATTRIBUTES",
    "TEMP",
    "TEMP_ATTRIBUTES",
    "MXSPD",
    "MAX",
    "MAX_ATTRIBUTES",
    "GUST",
    "MIN",
    "MIN_ATTRIBUTES",
    "VISIB",
    "VISIB_ATTRIBUTES",
    "PRCP",
    "PRCP_ATTRIBUTES",
    "SNDP",
    "FRSHTT",
    "STP",
    "STP_ATTRIBUTES",
    "SLP",
    "SLP_ATTRIBUTES",
    *AUDIT,
)
WEATHER_BRONZE_FILLED = (
    "STATION",
    "DATE",
    "DEWP",
    "WDSP",
    "TEMP",
    "MXSPD",
    "MAX",
    "MIN",
    "VISIB",
    "PRCP",
    "source_year",
    "source_month",
)
WEATHER_SILVER_COLUMNS = (
    "STATION",
    "DATE",
    "LATITUDE",
    "LONGITUDE",
    "ELEVATION",
    "NAME",
    "TEMP",
    "DEWP",
    "SLP",
    "STP",
    "VISIB",
    "WDSP",
    "MXSPD",
    "GUST",
    "MAX",
    "MIN",
    "PRCP",
    "SNDP",
    "source_year",
    "source_month",
    "source_file",
    "ingested_at",
    "season_northern",
    "is_weekend",
    "day_name",
    "temp_c",
    "max_temp_c",
    "min_temp_c",
    "wdsp_kmh",
    "mxspd_kmh",
    "gust_kmh",
    "is_freezing",
    "is_extreme_heat",
    "has_precipitation",
    "is_gale",
    "processed_at",
)
WEATHER_SILVER_FILLED = (
    "STATION",
    "DATE",
    "TEMP",
    "WDSP",
    "VISIB",
    "PRCP",
    "LATITUDE",
    "LONGITUDE",
    "source_year",
    "source_month",
    "source_file",
    "ingested_at",
    "season_northern",
    "day_name",
    "is_weekend",
    "is_freezing",
    "is_extreme_heat",
    "has_precipitation",
    "is_gale",
    "temp_c",
    "processed_at",
)
WEATHER_SILVER_SPARSE = (
    "DEWP",
    "SLP",
    "STP",
    "MXSPD",
    "GUST",
    "MAX",
    "MIN",
    "SNDP",
    "max_temp_c",
    "min_temp_c",
    "mxspd_kmh",
    "gust_kmh",
)
SEASON_NAMES = ("winter", "spring", "summer", "fall")
MONTH_NUMBERS = tuple(range(1, 13))

# Row bounds per batch, and shares of filled values.
TRIP_BRONZE_ROWS = (200_000, 6_000_000)
TRIP_SILVER_ROWS = (180_000, 5_800_000)
WEATHER_BRONZE_ROWS = (1_000_000, 5_000_000)
WEATHER_SILVER_ROWS = (800_000, 5_000_000)
BRONZE_SHARE, SPARSE_SHARE = 0.9, 0.75


def trip_bronze_suite(rows: tuple[int, int] = TRIP_BRONZE_ROWS) -> list[Check]:
    return [
        row_count(*rows),
        *exist(TRIP_BRONZE_COLUMNS),
        *not_null(TRIP_BRONZE_FILLED, BRONZE_SHARE),
    ]


def trip_silver_suite(
    rows: tuple[int, int] = TRIP_SILVER_ROWS, last_weekday: int = 6
) -> list[Check]:
    return [
        row_count(*rows),
        *exist(TRIP_SILVER_COLUMNS),
        *not_null(TRIP_SILVER_FILLED),
        *not_null(TRIP_SILVER_SPARSE, SPARSE_SHARE),
        between("fare_amount", 0, 500),
        between("trip_distance", 0),
        between("passenger_count", 1, 6),
        between("trip_duration_minutes", 1, 1440),
        between("pickup_hour", 0, 23),
        between("pickup_day_of_week", 0, last_weekday),
        pair_greater("tpep_dropoff_datetime", "tpep_pickup_datetime"),
        in_set("payment_method", PAYMENT_NAMES),
        in_set("day_name", WEEKDAYS),
        in_set("is_weekend", (True, False)),
        in_set("source_month", MONTH_NUMBERS),
    ]


def weather_bronze_suite(rows: tuple[int, int] = WEATHER_BRONZE_ROWS) -> list[Check]:
    return [
        row_count(*rows),
        *exist(WEATHER_BRONZE_COLUMNS),
        *not_null(WEATHER_BRONZE_FILLED, BRONZE_SHARE),
    ]


def weather_silver_suite(rows: tuple[int, int] = WEATHER_SILVER_ROWS) -> list[Check]:
    flags = ("is_weekend", "is_freezing", "is_extreme_heat", "has_precipitation", "is_gale")
    return [
        row_count(*rows),
        *exist(WEATHER_SILVER_COLUMNS),
        *not_null(WEATHER_SILVER_FILLED),
        *not_null(WEATHER_SILVER_SPARSE, SPARSE_SHARE),
        between("LATITUDE", -90, 90),
        between("LONGITUDE", -180, 180),
        between("ELEVATION", -500, 9000),
        between("TEMP", -129, 135),
        between("temp_c", -89, 57),
        between("WDSP", 0, 200),
        between("wdsp_kmh", 0, 370),
        between("PRCP", 0, 30),
        between("VISIB", 0, 999),
        in_set("season_northern", SEASON_NAMES),
        *[in_set(flag, (True, False)) for flag in flags],
        in_set("source_month", MONTH_NUMBERS),
        unique_count("source_month", 12, 12),
        compound_unique(("STATION", "DATE")),
    ]
