"""Batch ranges, calendars and per-batch summaries."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.functions import count_where
from tierwise.operators.rules import Rule
from tierwise.schemas import PARTITION_KEYS

# First year with data.
FIRST_TRIP_YEAR, FIRST_WEATHER_YEAR = 2009, 1929

_AS_KEYS = (
    "CAST(year(month) AS SMALLINT) AS source_year",
    "CAST(month(month) AS TINYINT) AS source_month",
)


@dataclass(frozen=True)
class BatchRange:
    """A checked range of monthly batches, both ends included."""

    first: tuple[int, int]
    last: tuple[int, int]
    earliest_year: int = FIRST_TRIP_YEAR

    def __post_init__(self) -> None:
        this_year = datetime.date.today().year
        for year, month in (self.first, self.last):
            if not self.earliest_year <= year <= this_year:
                raise ValueError(f"year {year} is not in {self.earliest_year}..{this_year}")
            if not 1 <= month <= 12:
                raise ValueError(f"month {month} is not in 1..12")
        if self.first > self.last:
            raise ValueError(f"range starts at {self.first} after its end {self.last}")

    @classmethod
    def of_year(
        cls,
        year: int,
        month_start: int | None = None,
        month_end: int | None = None,
        earliest_year: int = FIRST_TRIP_YEAR,
    ) -> BatchRange:
        """A year, or part of one; giving only one end is an error."""
        if (month_start is None) != (month_end is None):
            raise ValueError("give both the first and the last month, or neither")
        first = 1 if month_start is None else month_start
        last = 12 if month_end is None else month_end
        return cls((year, first), (year, last), earliest_year)

    def calendar(self, spark: SparkSession) -> DataFrame:
        first, last = (f"DATE'{y:04d}-{m:02d}-01'" for y, m in (self.first, self.last))
        return spark.range(1).selectExpr(
            f"explode(sequence({first}, {last}, INTERVAL 1 MONTH)) AS month"
        ).selectExpr(*_AS_KEYS)


def months_spanned(df: DataFrame, whole_years: bool = False) -> DataFrame:
    """All months from the first to the last batch of a table, or of the years
    they fall in: one aggregated row, unfolded."""
    ends = df.agg(
        F.expr("min(make_date(source_year, source_month, 1))").alias("first"),
        F.expr("max(make_date(source_year, source_month, 1))").alias("last"),
    )
    if whole_years:
        ends = ends.selectExpr(
            "make_date(year(first), 1, 1) AS first", "make_date(year(last), 12, 1) AS last"
        )
    return ends.selectExpr(
        "explode(sequence(first, last, INTERVAL 1 MONTH)) AS month"
    ).selectExpr(*_AS_KEYS)


def calendar_with_rows(requested: DataFrame, df: DataFrame) -> DataFrame:
    """Every requested batch with its row count and whether it has any rows."""
    rows = df.groupBy(*PARTITION_KEYS).agg(F.count("*").alias("rows"))
    return requested.join(rows, list(PARTITION_KEYS), "left").selectExpr(
        *PARTITION_KEYS, "coalesce(rows, 0L) AS rows", "rows IS NOT NULL AS landed"
    )


def missing_batches(requested: DataFrame, df: DataFrame) -> DataFrame:
    """Requested batches without a single row."""
    found = df.select(*PARTITION_KEYS).distinct()
    return requested.join(found, list(PARTITION_KEYS), "left_anti")


def backfill_summary(requested: DataFrame, bronze: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Outcome of cleaning each requested batch, all in one pass."""
    kept = " AND ".join(f"({r.condition})" for r in rules)
    outcome = (
        bronze.selectExpr(*PARTITION_KEYS, f"coalesce({kept}, FALSE) AS kept")
        .groupBy(*PARTITION_KEYS)
        .agg(F.count("*").alias("bronze_rows"), F.expr(count_where("kept")).alias("silver_rows"))
    )
    return requested.join(outcome, list(PARTITION_KEYS), "left").selectExpr(
        "concat(source_year, '-', lpad(source_month, 2, '0')) AS batch",
        "coalesce(bronze_rows, 0L) AS bronze_rows",
        "coalesce(silver_rows, 0L) AS silver_rows",
        "coalesce(bronze_rows - silver_rows, 0L) AS dropped_rows",
        "CASE WHEN silver_rows > 0 THEN 'success' ELSE 'failed' END AS status",
    )


def summary_totals(summary: DataFrame) -> DataFrame:
    """How many batches succeeded and failed, and which failed."""
    return summary.agg(
        F.expr(count_where("status = 'success'")).alias("successful"),
        F.expr(count_where("status = 'failed'")).alias("failed"),
        F.expr(
            "array_join(array_sort(collect_list(CASE WHEN status = 'failed' THEN batch END)), ', ')"
        ).alias("failed_batches"),
    )
