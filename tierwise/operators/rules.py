"""Named cleaning rules.

One list per domain gives both the filter and the per-rule drop report. A rule
that evaluates to null fails, as it would in a WHERE clause.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tierwise.functions import count_where, minutes_between, number
from tierwise.schemas import PARTITION_KEYS

# Thresholds of the trip rules.
MIN_FARE, MAX_FARE = 0, 500
MIN_DISTANCE = 0
MIN_PASSENGERS, MAX_PASSENGERS = 1, 6
MIN_MINUTES, MAX_MINUTES = 1, 1440

# Missing-value markers and plausible ranges of the station days.
SENTINELS = {"TEMP": 9999.9, "WDSP": 999.9, "PRCP": 99.99, "VISIB": 999.9}
SNOW_SENTINEL = 999.9
WINTER_MONTHS = (12, 1, 2)
POSITION_RANGES = {"LATITUDE": (-90, 90), "LONGITUDE": (-180, 180), "ELEVATION": (-500, 9000)}
VALUE_RANGES = {"TEMP": (-129, 135), "WDSP": (0, 200), "PRCP": (0, 6), "VISIB": (0, 999)}

TRIP_REQUIRED = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
    "trip_distance",
    "passenger_count",
    "payment_type",
)
WEATHER_REQUIRED = (
    "STATION",
    "DATE",
    "TEMP",
    "WDSP",
    "VISIB",
    "PRCP",
    "LATITUDE",
    "LONGITUDE",
)


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str


def _every(conditions: Sequence[str]) -> str:
    return " AND ".join(f"({c})" for c in conditions)


def _required(columns: Sequence[str]) -> str:
    return _every([f"{c} IS NOT NULL" for c in columns])


def _in_ranges(ranges: dict[str, tuple[int, int]]) -> str:
    return _every([f"{number(c)} BETWEEN {low} AND {high}" for c, (low, high) in ranges.items()])


def trip_rules() -> list[Rule]:
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    minutes = minutes_between(pickup, dropoff)
    return [
        Rule("required", _required(TRIP_REQUIRED)),
        Rule("fare", f"fare_amount > {MIN_FARE} AND fare_amount < {MAX_FARE}"),
        Rule("distance", f"trip_distance >= {MIN_DISTANCE}"),
        Rule("passengers", f"passenger_count BETWEEN {MIN_PASSENGERS} AND {MAX_PASSENGERS}"),
        Rule("time_order", f"{pickup} < {dropoff}"),
        Rule("duration", f"{minutes} BETWEEN {MIN_MINUTES} AND {MAX_MINUTES}"),
        # Compared with the batch columns, so that all batches run as one job.
        Rule("batch", f"year({pickup}) = source_year AND month({pickup}) = source_month"),
    ]


def weather_rules(today: str = "current_date()") -> list[Rule]:
    """`today` is an expression, a parameter so that tests can fix the date."""
    temp, dewp, snow = number("TEMP"), number("DEWP"), number("SNDP")
    low, high = number("`MIN`"), number("`MAX`")
    no_extremes = "`MIN` IS NULL OR `MAX` IS NULL"
    date = "try_cast(`DATE` AS DATE)"
    winter = ", ".join(map(str, WINTER_MONTHS))
    return [
        Rule("required", _required([f"`{c}`" for c in WEATHER_REQUIRED])),
        Rule("sentinel", _every([f"{number(c)} < {limit}D" for c, limit in SENTINELS.items()])),
        Rule(
            "winter_snow",
            f"source_month NOT IN ({winter}) OR (SNDP IS NOT NULL AND {snow} < {SNOW_SENTINEL}D)",
        ),
        Rule("position", _in_ranges(POSITION_RANGES)),
        Rule("plausible", _in_ranges(VALUE_RANGES)),
        Rule(
            "consistent",
            _every(
                [
                    f"DEWP IS NULL OR {dewp} <= {temp}",
                    f"{no_extremes} OR {low} <= {high}",
                    f"{no_extremes} OR {temp} BETWEEN {low} AND {high}",
                ]
            ),
        ),
        Rule("not_future", f"{date} <= {today}"),
        Rule("batch", f"year({date}) = source_year"),
    ]


def keep(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows for which every rule holds."""
    return df.where(_every([r.condition for r in rules]))


def _measures(rules: Sequence[Rule]) -> list[str]:
    """Rows read, kept and dropped, and those each rule rejects, over flags by rule name."""
    kept = count_where(_every([r.name for r in rules]))
    return [
        "count(*) AS rows_read",
        f"{kept} AS rows_kept",
        f"count(*) - {kept} AS rows_dropped",
        *[f"{count_where(f'NOT {r.name}')} AS failed_{r.name}" for r in rules],
    ]


def _flag(rule: Rule) -> str:
    return f"coalesce({rule.condition}, FALSE)"


def drop_report(
    df: DataFrame, rules: Sequence[Rule], batch: Sequence[str] = PARTITION_KEYS
) -> DataFrame:
    """Per batch: rows read, kept and dropped, and how many rows each rule
    rejects. A row may fail several rules, so these counts can overlap."""
    flags = df.selectExpr(*batch, *[f"{_flag(r)} AS {r.name}" for r in rules])
    return flags.groupBy(*batch).agg(*[F.expr(x) for x in _measures(rules)])


def observed(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """The rows as they are, and the totals of their drop report, which are counted
    while an action reads the rows: cleaning and its report take one pass. A task
    that is run again after its executor was lost counts once more."""
    flags = {f"_rule_{r.name}": F.expr(_flag(r)) for r in rules}
    named = [Rule(f"_rule_{r.name}", r.condition) for r in rules]
    seen = Observation()
    measures = [F.expr(x.replace("AS failed__rule_", "AS failed_")) for x in _measures(named)]
    return df.withColumns(flags).observe(seen, *measures).drop(*flags), seen
