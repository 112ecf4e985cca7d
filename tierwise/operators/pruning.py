"""Whole-table reads against reads of one partition."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Metrics of a file scan: how they are called in a plan, and here.
_SCAN_METRICS = {"numFiles": "files", "filesSize": "bytes", "numPartitions": "partitions"}


def scan_month(df: DataFrame, year: int, month: int) -> DataFrame:
    """One month; on a partitioned table only its folder is read."""
    return df.where((F.col("source_year") == year) & (F.col("source_month") == month))


def scan_year(df: DataFrame, year: int) -> DataFrame:
    """One year; on a partitioned table only its folders are read."""
    return df.where(F.col("source_year") == year)


def pruning_rows(df: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of a whole read and of a read with the partition filter, rows
    skipped, and the share read. Only partition columns are needed, so no data
    page is read, and the filtered read lists one partition."""
    full = df.agg(F.count("*").alias("rows_full"), F.lit(0).cast("long").alias("rows_read"))
    read = scan_month(df, year, month).agg(F.lit(0).cast("long").alias("rows_full"), F.count("*").alias("rows_read"))
    return full.unionAll(read).agg(
        F.sum("rows_full").alias("rows_full"),
        F.sum("rows_read").alias("rows_read"),
        (F.sum("rows_full") - F.sum("rows_read")).alias("rows_skipped"),
        F.expr("CAST(sum(rows_read) AS DOUBLE) * 100 / nullif(CAST(sum(rows_full) AS DOUBLE), 0D)").alias("read_pct"),
    )


# What an adaptive plan wraps its parts in, by the method that unwraps it.
_WRAPPERS = {
    "executedPlan": ("AdaptiveSparkPlanExec",),
    "plan": ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "TableCacheQueryStageExec", "ResultQueryStageExec"),
}


def _file_scans(plan) -> Iterator:
    """The file scans of an executed plan, also within adaptive stages."""
    for inner in ("executedPlan", "plan"):
        if plan.getClass().getSimpleName() in _WRAPPERS[inner]:
            yield from _file_scans(getattr(plan, inner)())
            return
    if plan.getClass().getSimpleName() == "FileSourceScanExec":
        yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from _file_scans(children.apply(i))


def scan_figures(df: DataFrame) -> dict[str, int]:
    """Rows of a plan, and what its file scans have opened for them: files, bytes
    and partitions, as the executed plan's metrics tell."""
    counted = df.agg(F.count("*").alias("rows"))
    # Its own plan has to run: `first` would make another.
    figures = {"rows": counted.collect()[0].rows, **dict.fromkeys(_SCAN_METRICS.values(), 0)}
    for scan in _file_scans(counted._jdf.queryExecution().executedPlan()):
        for metric, name in _SCAN_METRICS.items():
            value = scan.metrics().get(metric)
            figures[name] += value.get().value() if value.isDefined() else 0
    return figures


def pruning_scans(df: DataFrame, year: int, month: int) -> DataFrame:
    """What a whole read and a read with the partition filter have opened, a row each:
    read, rows, partitions, files, bytes."""
    reads = {"full": df, "month": scan_month(df, year, month)}
    rows = [(name, *map(scan_figures(read).get, ("rows", "partitions", "files", "bytes"))) for name, read in reads.items()]
    return df.sparkSession.createDataFrame(rows, "read STRING, rows BIGINT, partitions BIGINT, files BIGINT, bytes BIGINT")


def mean_seconds(plan: Callable[[], DataFrame], runs: int = 3) -> float:
    """Mean time to read every row and column of a plan."""
    total = 0.0
    for _ in range(runs):
        start = time.perf_counter()
        plan().write.format("noop").mode("overwrite").save()
        total += time.perf_counter() - start
    return total / runs


def compare(full: Callable[[], DataFrame], pruned: Callable[[], DataFrame], runs: int = 3) -> dict:
    """Mean read times, speed-up factor and improvement in percent."""
    slow, fast = mean_seconds(full, runs), mean_seconds(pruned, runs)
    return {
        "full_sec": slow,
        "pruned_sec": fast,
        "speedup": slow / fast,
        "improvement_pct": (slow - fast) / slow * 100,
    }
