"""Gold tables in the session catalog, for SQL clients."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.operators.versions import VersionedTable
from tierwise.schemas import PARTITION_KEYS

# Served names of the Gold models.
SERVED_NAMES = {
    "daily_summary": "taxi_daily_summary",
    "hourly_summary": "taxi_hourly_summary",
    "individual_day_summary": "taxi_individual_day_summary",
    "payment_summary": "taxi_payment_summary",
    "zone_performance": "taxi_zone_performance",
    "daily_climate": "weather_daily_climate",
    "monthly_climate": "weather_monthly_climate",
    "station_metrics": "weather_station_metrics",
}


def register(spark: SparkSession, models: dict[str, VersionedTable], schema: str = "gold") -> list[str]:
    """Drop and recreate the served tables of a schema in the session's catalog.
    Other tables of the schema stay.

    A served table is an external one without files of its own: its partitions are
    the folders of the live partitions, so nothing is copied, and a query that names
    a month lists that month's folder alone. `refresh` follows a commit.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name in SERVED_NAMES.values():
        spark.sql(f"DROP TABLE IF EXISTS {schema}.{name}")
    return [_create(spark, f"{schema}.{SERVED_NAMES[model]}", table) for model, table in models.items()]


def _create(spark: SparkSession, name: str, table: VersionedTable) -> str:
    columns, folders = table.live()
    fields = ", ".join(f"`{c.name}` {c.type}" for c in columns)
    keys = ", ".join(PARTITION_KEYS)
    spark.sql(f"CREATE TABLE {name} ({fields}) USING PARQUET PARTITIONED BY ({keys}) LOCATION '{_quoted(table.path)}/served'")
    _add(spark, name, folders)
    return name


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def _spec(key: tuple[int, int | None]) -> str:
    year, month = key
    return f"PARTITION (source_year = {year}, source_month = {'NULL' if month is None else month})"


def _add(spark: SparkSession, name: str, folders: dict[tuple[int, int | None], str]) -> None:
    if folders:
        parts = " ".join(f"{_spec(key)} LOCATION '{_quoted(folder)}'" for key, folder in folders.items())
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")


def refresh(spark: SparkSession, model: str, table: VersionedTable, schema: str = "gold") -> str:
    """Point a served table at what is live now. Partitions that did not change stay
    as they are; a table whose columns have changed is made anew."""
    name = f"{schema}.{SERVED_NAMES[model]}"
    columns, folders = table.live()
    served = {f.name: f.dataType.simpleString() for f in spark.table(name).schema}
    if served != {c.name: c.type for c in columns}:
        spark.sql(f"DROP TABLE {name}")
        return _create(spark, name, table)
    now = served_folders(spark, name)
    gone = [key for key, folder in now.items() if folders.get(key) != folder]
    for key in gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {_spec(key)}")
    _add(spark, name, {key: folder for key, folder in folders.items() if now.get(key) != folder})
    spark.catalog.refreshTable(name)
    return name


def served_folders(spark: SparkSession, name: str) -> dict[tuple[int, int | None], str]:
    """Folder of every partition of a served table, a row per partition of the catalog."""
    found = {}
    for (partition,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
        year, month = (part.split("=", 1)[1] for part in partition.split("/"))
        key = (int(year), int(month) if month.isdigit() else None)
        rows = spark.sql(f"DESCRIBE FORMATTED {name} {_spec(key)}").collect()
        found[key] = next(r.data_type for r in rows if r.col_name == "Location").removeprefix("file:")
    return found


def list_tables(spark: SparkSession, schema: str = "gold") -> DataFrame:
    """Tables of a schema, in order."""
    if not spark.catalog.databaseExists(schema):
        return spark.createDataFrame([], "table_name STRING, table_schema STRING")
    names = [(t.name, schema) for t in spark.catalog.listTables(schema) if not t.isTemporary]
    return spark.createDataFrame(names, "table_name STRING, table_schema STRING").orderBy("table_name")


def table_rows(spark: SparkSession, schema: str = "gold") -> DataFrame:
    """Tables of a schema with their row counts, asked through SQL."""
    names = [r.table_name for r in list_tables(spark, schema).collect()]
    if not names:
        return spark.createDataFrame([], "table_name STRING, table_schema STRING, rows BIGINT")
    counts = [
        spark.sql(f"SELECT '{n}' AS table_name, '{schema}' AS table_schema, count(*) AS rows FROM {schema}.{n}")
        for n in names
    ]
    return reduce(DataFrame.unionAll, counts).orderBy(F.col("table_name"))
