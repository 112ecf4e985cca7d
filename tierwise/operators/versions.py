"""A partitioned Parquet table whose earlier states can still be read.

Every commit writes its rows below its own `_commit=N` folder and then appends
one row to a small commits table: version, time, operation, the batch it
replaces, the partitions it wrote with their row counts, and the schema of the
table from then on. Readers only see partitions named by a commits row, so an
unfinished write is invisible and a repeated one overwrites its own folder.
One writer at a time is assumed.

What is live at a version follows from the commits table alone: a partition
lives from the commit that wrote it until the next commit that covers its
(year, month). Superseded files are never listed.
"""

from __future__ import annotations

import contextlib
import datetime
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwise.schemas import PARTITION_KEYS, PARTITION_TYPES
from tierwise.session import open_writers

_COMMITS = (
    "version INT, ts TIMESTAMP, operation STRING,"
    " replaced ARRAY<STRUCT<source_year: SMALLINT, source_month: TINYINT>>,"
    " partitions ARRAY<STRUCT<source_year: SMALLINT, source_month: TINYINT, rows: BIGINT>>,"
    " rows BIGINT, schema ARRAY<STRUCT<name: STRING, type: STRING>>, source STRUCT<stream: STRING, batch: BIGINT>"
)

Batch = tuple[int, int | None]

# How a partition folder spells a null.
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"

# Widenings under which Parquet files written earlier remain readable.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # --- commits table ---------------------------------------------------

    def exists(self) -> bool:
        """Whether anything has been committed."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def commits(self) -> DataFrame:
        """One row per version; tiny, as it grows by one row per commit."""
        if not self.exists():
            return self.spark.createDataFrame([], _COMMITS)
        return self.spark.read.schema(_COMMITS).option("recursiveFileLookup", "true").json(
            f"{self.path}/commits"
        )

    def history(self, last: int | None = None) -> DataFrame:
        """Newest first, as many as asked for: version, time, operation, the
        replaced batches as a predicate, and the rows written."""
        one = (
            "concat('source_year = ', b.source_year,"
            " coalesce(concat(' AND source_month = ', b.source_month), ''))"
        )
        predicate = f"array_join(transform(replaced, b -> {one}), ' OR ')"
        rows = self.commits().selectExpr(
            "version", "ts", "operation", f"nullif({predicate}, '') AS predicate", "rows"
        ).orderBy(F.desc("version"))
        return rows if last is None else rows.limit(last)

    def latest_version(self, at: datetime.datetime | str | None = None) -> int | None:
        """Newest version, or the newest one committed by the given time."""
        commits = self.commits()
        if at is not None:
            commits = commits.where(F.col("ts") <= F.lit(at).cast("timestamp"))
        return commits.agg(F.max("version")).first()[0]

    def _log(self) -> list[T.Row]:
        """All commits in order: a row per version, in one job."""
        if not self.exists():
            return []
        return sorted(self.commits().collect(), key=lambda c: c.version)

    # --- writing ---------------------------------------------------------

    def commit(
        self,
        df: DataFrame,
        replace: Sequence[Batch] = (),
        operation: str = "WRITE",
        sort: Sequence[str] = (),
        source: tuple[str, int] | None = None,
        laid_out: bool = False,
        replace_by: Sequence[str] = (),
    ) -> int | None:
        """Create the table, or replace whole batches of it in one step.

        A batch is (year, month), or (year, None) for a whole year; months of a
        replaced year that the new rows lack are gone afterwards, and so are its
        rows without a month. Rows without a year are refused. Returns the new
        version, or None, with a warning, if there were no rows to write.

        `source` names a stream and its batch. It is stored with the version, and a
        batch that has been committed before is not written again: its version is
        returned. So a stream that failed after a commit and before its own
        checkpoint may hand on the same batch once more.

        `laid_out` says that the rows come from files of few batches each, such as
        those of another table: they are written by the tasks that read them, and
        neither shuffled nor sorted.

        `replace_by` names the partition columns of a batch, where the batches to
        replace are those that the rows turn out to be in.
        """
        log = self._log()
        for done in log if source else ():
            if done.source and tuple(done.source) == tuple(source):
                return done.version
        latest, schema = (log[-1].version, {f.name: f.type for f in log[-1].schema}) if log else (-1, {})
        if latest >= 0 and not (replace or replace_by):
            raise ValueError("name the batches to replace in an existing table")
        version = latest + 1
        df, schema = _merge_schema(df, schema)
        folder = f"{self.path}/data/_commit={version}"
        if sort or not laid_out:
            # Rows of a partition go to as many tasks as its size asks for: the
            # rebalance splits a partition that holds most of the rows and joins
            # small ones, where a plain repartition by key would use one task each.
            df = df.hint("rebalance", *PARTITION_KEYS)
        if sort:
            df = df.sortWithinPartitions(*PARTITION_KEYS, *sort)
        # Without an order to keep, a task's few partitions are kept apart by their files.
        with contextlib.nullcontext() if sort else open_writers(self.spark):
            df.write.mode("overwrite").partitionBy(*PARTITION_KEYS).parquet(folder)
        written = self._count(folder, df.schema)
        if not written:
            warnings.warn(f"no rows to write to {self.path}", stacklevel=2)
            return None
        monthly = "source_month" in replace_by
        allowed = {tuple(batch) for batch in replace}
        if replace_by:
            allowed = {(year, month if monthly else None) for year, month, _ in written}
        for year, month, _ in written:
            if year is None or monthly and month is None:
                raise ValueError(f"rows without a source_{'year' if year is None else 'month'} have no batch")
            if allowed and not {(year, month), (year, None)} & allowed:
                raise ValueError(f"rows of {year}-{month} are outside the replaced batches")
        record = (
            version,
            datetime.datetime.now(datetime.timezone.utc),
            operation,
            sorted(allowed, key=lambda batch: (batch[0], batch[1] or 0)),
            written,
            sum(rows for _, _, rows in written),
            list(schema.items()),
            source,
        )
        self.spark.createDataFrame([record], _COMMITS).coalesce(1).write.mode("errorifexists").json(
            f"{self.path}/commits/v{version}"
        )
        return version

    def _count(self, folder: str, written: T.StructType) -> list[tuple[int, int, int]]:
        """Rows per partition of the files just written: one number for each
        (year, month), counted without reading a data column."""
        if not _has_files(self.spark, folder):
            return []
        counted = (
            self.spark.read.schema(_with_partition_types(written))
            .parquet(folder)
            .groupBy(*PARTITION_KEYS)
            .agg(F.count("*").alias("n"))
            .orderBy(*PARTITION_KEYS)
        )
        return [(r.source_year, r.source_month, r.n) for r in counted.collect()]

    # --- reading ---------------------------------------------------------

    def lifetimes(self) -> DataFrame:
        """Partitions with the version that wrote them and the version, if any,
        that superseded them. A year commit covers all twelve months, and the rows
        of the year that have none."""
        commits = self.commits()
        written = commits.select("version", F.explode("partitions").alias("p")).select(
            "p.source_year", "p.source_month", "version", "p.rows"
        )
        covered = commits.select("version", F.inline("replaced")).selectExpr(
            "source_year",
            "explode(CASE WHEN source_month IS NULL"
            " THEN CAST(sequence(1, 12) || array(NULL) AS ARRAY<TINYINT>)"
            " ELSE array(source_month) END) AS source_month",
            "version",
            "0L AS rows",
        )
        events = (
            written.unionByName(covered)
            .groupBy(*PARTITION_KEYS, "version")
            .agg(F.sum("rows").alias("rows"))
        )
        per_month = Window.partitionBy(*PARTITION_KEYS).orderBy("version")
        return events.select(
            *PARTITION_KEYS,
            "rows",
            F.col("version").alias("from_version"),
            F.lead("version").over(per_month).alias("to_version"),
        ).where("rows > 0")

    def replaced(self, version: int) -> list[Batch]:
        """The batches that a version replaced, in order."""
        return [tuple(batch) for commit in self._log() if commit.version == version for batch in commit.replaced]

    def live(self, version: int | None = None) -> tuple[list[T.Row], dict[tuple[int, int | None], str]]:
        """Schema (name, type) of a version, by default the newest, and the folder of
        every partition that is live then, by (year, month). One job over the
        commits; the driver receives a row per commit."""
        log = self._log()
        if version is None and log:
            version = log[-1].version
        log = [c for c in log if version is not None and c.version <= version]
        if not log or log[-1].version != version:
            raise ValueError(f"no version {version} in {self.path}")
        wrote: dict[tuple[int, int | None], int] = {}
        for commit in log:
            for year, month in commit.replaced:
                wrote = {p: v for p, v in wrote.items() if p[0] != year or month is not None and p[1] != month}
            wrote |= {(p.source_year, p.source_month): commit.version for p in commit.partitions}
        return log[-1].schema, {
            (year, month): f"{self.path}/data/_commit={commit}/source_year={year}"
            f"/source_month={_NO_VALUE if month is None else month}"
            for (year, month), commit in wrote.items()
        }

    def as_of(self, version: int | None = None) -> DataFrame:
        """The table as it was at a version, by default the newest.

        Only the folders of live partitions are listed, the same list that Spark
        keeps for any partitioned table.
        """
        schema, folders = self.live(version)
        fields = ", ".join(f"`{f.name}` {f.type}" for f in schema)
        if not folders:
            return self.spark.createDataFrame([], fields)
        reader = self.spark.read.schema(f"{fields}, _commit INT").option(
            "basePath", f"{self.path}/data"
        )
        return reader.parquet(*folders.values()).select(*[f"`{f.name}`" for f in schema])

    def as_of_time(self, at: datetime.datetime | str) -> DataFrame:
        """The table as it was at a point in time."""
        version = self.latest_version(at)
        if version is None:
            raise ValueError(f"no version of {self.path} at {at}")
        return self.as_of(version)

    def read(self) -> DataFrame:
        """The live table."""
        return self.as_of()

    # --- audits ----------------------------------------------------------

    def rows_per_version(self) -> DataFrame:
        """Row count of the table at each version, from the commits table only.
        The running sum is over one number per version."""
        lifetimes = self.lifetimes()
        gained = lifetimes.selectExpr("from_version AS version", "rows")
        lost = lifetimes.where("to_version IS NOT NULL").selectExpr("to_version AS version", "-rows")
        change = gained.union(lost).groupBy("version").agg(F.sum("rows").alias("rows"))
        running = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, 0)
        return change.select("version", F.sum("rows").over(running).alias("rows"))

    def schema_history(self) -> DataFrame:
        """Columns and types of the table at each version, one row each."""
        return self.commits().select(
            "version", F.posexplode("schema").alias("position", "field")
        ).select("version", "position", F.col("field.name").alias("name"), F.col("field.type").alias("type"))

    def schema_drift(self, baseline: int = 0) -> DataFrame:
        """Columns added, removed or changed at each version against a baseline."""
        first = next(c for c in self._log() if c.version == baseline)
        base = ", ".join(f"'{f.name}', '{f.type}'" for f in first.schema)
        names = "explode(array_union(map_keys(now), map_keys(base))) AS name"
        return (
            self.commits()
            .where(F.col("version") != baseline)
            .selectExpr("version", "map_from_entries(schema) AS now", f"map({base}) AS base")
            .selectExpr("version", "now", "base", names)
            .selectExpr("version", "name", "base[name] AS old_type", "now[name] AS new_type")
            .withColumn("change", _change())
            .where("change IS NOT NULL")
        )


def schema_rows(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A DataFrame's schema as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "name STRING, type STRING")


def _change() -> Column:
    return (
        F.when(F.col("old_type").isNull(), "ADDED")
        .when(F.col("new_type").isNull(), "REMOVED")
        .when(F.col("old_type") != F.col("new_type"), "CHANGED")
    )


def schema_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Differences of two schemas given as rows: name, old and new type, change."""
    return (
        old.withColumnRenamed("type", "old_type")
        .join(new.withColumnRenamed("type", "new_type"), "name", "full_outer")
        .withColumn("change", _change())
        .where("change IS NOT NULL")
    )


def filled_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns added, removed or changed from one table to another, with the rows
    that have a value in them on either side, null where the column is not there.

    One aggregate per table, over the columns that differ only."""
    spark = old.sparkSession
    changes = schema_changes(schema_rows(spark, old), schema_rows(spark, new))

    def filled(df: DataFrame, name: str, side: str) -> DataFrame:
        types = dict(new.dtypes if df is old else old.dtypes)
        columns = [c for c, t in df.dtypes if types.get(c) != t]
        counts = [F.struct(F.lit(c).alias("name"), F.count(f"`{c}`").alias(side)) for c in columns]
        if not counts:
            return spark.createDataFrame([], f"name STRING, {side} BIGINT")
        return df.agg(F.array(*counts).alias(name)).select(F.inline(name))

    return changes.join(filled(old, "counts", "old_filled"), "name", "left").join(
        filled(new, "counts", "new_filled"), "name", "left"
    )


def _has_files(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/source_year=*")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(fs.globStatus(path)) > 0


def _with_partition_types(schema: T.StructType) -> T.StructType:
    """Partition folders carry no types, so the reader is told them."""
    kept = [f for f in schema.fields if f.name not in PARTITION_TYPES]
    typed = T.StructType.fromDDL(", ".join(f"{k} {t}" for k, t in PARTITION_TYPES.items()))
    return T.StructType(kept + typed.fields)


def _merge_schema(df: DataFrame, table: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """Rows with the table's spelling of names, and the table's next schema.

    Columns that differ only in case are the same column. New columns are
    added; older rows read them as null. A type may widen, not change."""
    spelling = {name.lower(): name for name in table}
    df = df.withColumnsRenamed({c: spelling.get(c.lower(), c) for c in df.columns})
    df = df.withColumns({k: F.col(k).cast(t) for k, t in PARTITION_TYPES.items()})
    merged = dict(table)
    casts = {}
    for field in df.schema.fields:
        new, old = field.dataType.simpleString(), table.get(field.name)
        if old is None or new in _WIDER.get(old, ()):
            merged[field.name] = new
        elif old in _WIDER.get(new, ()):
            casts[field.name] = F.col(field.name).cast(old)
        elif old != new:
            raise ValueError(f"column {field.name} changes from {old} to {new}")
    return (df.withColumns(casts) if casts else df), merged
