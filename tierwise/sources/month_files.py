"""Raw monthly Parquet batches: what has landed, and reading many at once."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from tierwise.schemas import TRIP_SOURCE
from tierwise.session import open_writers
from tierwise.sources.stores import open_file

# A batch is a file or folder whose name ends in YYYY-MM.parquet.
_BATCH = r"^(.*?(\d{4})-(0[1-9]|1[0-2])\.parquet)"
_MONTH = r"^\d{4}-(0[1-9]|1[0-2])$"

_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def listed_files(spark: SparkSession, root: str) -> DataFrame:
    """Parquet files below a folder; Spark lists names, contents are not opened."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .select("path")
    )


def landed_months(spark: SparkSession, root: str) -> DataFrame:
    """Batches found below a folder: year, month and path."""
    return landed_in(listed_files(spark, root))


def landed_in(files: DataFrame) -> DataFrame:
    """The batches that listed files belong to. Files that are in no batch are
    none of ours; `stray_files` tells them."""
    return (
        files.where(F.col("path").rlike(_BATCH))
        .select(
            F.regexp_extract("path", _BATCH, 2).cast("smallint").alias("source_year"),
            F.regexp_extract("path", _BATCH, 3).cast("tinyint").alias("source_month"),
            F.regexp_extract("path", _BATCH, 1).alias("path"),
        )
        .distinct()
    )


def stray_files(files: DataFrame) -> DataFrame:
    """Listed files whose name belongs to no batch."""
    return files.where(~F.col("path").rlike(_BATCH)).select("path").distinct()


def missing_months(requested: DataFrame, found: DataFrame) -> DataFrame:
    """Requested batches that have not landed."""
    keys = ["source_year", "source_month"]
    return requested.select(*keys).join(found.select(*keys).distinct(), keys, "left_anti")


def _spark_schema(path: str) -> T.StructType:
    """Schema of a Parquet file as Spark's reader sees it: the one Spark has left in
    the footer, or what the file's own types stand for."""
    with open_file(path) as file:
        footer = parquet.ParquetFile(file)
        own = (footer.metadata.metadata or {}).get(_SPARK_SCHEMA)
        if own:
            return T.StructType.fromJson(json.loads(own))
        schema = from_arrow_schema(footer.schema_arrow, prefer_timestamp_ntz=True)
        # The old timestamps of 96 bits are points in time for Spark.
        old = {c.path for c in (footer.schema.column(i) for i in range(len(footer.schema))) if c.physical_type == "INT96"}
        return T.StructType([T.StructField(f.name, T.TimestampType() if f.name in old else f.dataType) for f in schema])


def footers(files: DataFrame) -> DataFrame:
    """path and schema (JSON) of Parquet files (path): a task reads the footers of
    many of them, and nothing else. Whether a column may be null is left out."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            schemas = [
                T.StructType([T.StructField(f.name, f.dataType) for f in _spark_schema(path)]).json() for path in paths
            ]
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "schema": pa.array(schemas, pa.string())})

    return files.select("path").mapInArrow(read, "path STRING, schema STRING")


def _merged(schemas: list[T.StructType]) -> T.StructType | None:
    """All columns of several schemas, or none if one has two types."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            if fields.setdefault(field.name, field).dataType != field.dataType:
                return None
    return T.StructType(list(fields.values()))


def schema_groups(files: DataFrame) -> list[tuple[T.StructType, list[str]]]:
    """Schemas and the paths to read with each, for listed files of batches.

    One job, whatever the number of batches. A batch is one path; only where its
    files give a column two types, they are read one by one, each as it was written.
    """
    found = footers(files.where(F.col("path").rlike(_BATCH)).distinct())
    rows = (
        found.withColumn("batch", F.regexp_extract("path", _BATCH, 1))
        .groupBy("batch", "schema")
        .agg(F.min("path").alias("path"), F.count("*").alias("files"))
        .collect()  # a row per batch and schema in it
    )
    by_batch: dict[str, list[T.StructType]] = {}
    for row in rows:
        by_batch.setdefault(row.batch, []).append(T.StructType.fromJson(json.loads(row.schema)))
    alike: dict[str, tuple[T.StructType, list[str]]] = {}

    def add(schema: T.StructType, path: str) -> None:
        alike.setdefault(schema.simpleString(), (schema, []))[1].append(path)

    apart = []
    for batch, schemas in sorted(by_batch.items()):
        whole = _merged(schemas)
        if whole is None:
            apart.append(batch)
        else:
            add(whole, batch)
    if apart:
        rows = found.where(F.regexp_extract("path", _BATCH, 1).isin(apart)).collect()
        for row in sorted(rows):
            add(T.StructType.fromJson(json.loads(row.schema)), row.path)
    return list(alike.values())


def read_months(spark: SparkSession, root: str, requested: DataFrame | None = None) -> DataFrame:
    """Landed batches as one DataFrame with the contract's names and types.

    Every file's footer counts: a column that any file of a batch has is kept.
    Batches are grouped by schema, so the number of scans is the number of
    distinct schemas seen over the years, not of months. `source_file` is the
    file a row was read from. A batch that was asked for and has not landed is
    an error that names all of them.
    """
    files = listed_files(spark, root)
    if requested is not None:
        # At most one row per month asked for.
        missing = missing_months(requested, landed_in(files)).distinct().orderBy("source_year", "source_month").collect()
        if missing:
            names = ", ".join(f"{m.source_year}-{m.source_month:02d}" for m in missing)
            raise FileNotFoundError(f"batches not found in {root}: {names}")
        wanted = landed_in(files).join(requested, ["source_year", "source_month"], "left_semi")
        batch = F.regexp_extract(files["path"], _BATCH, 1)
        files = files.join(wanted.select(F.col("path").alias("wanted")), F.col("wanted") == batch, "left_semi")
    groups = schema_groups(files)
    if not groups:
        raise FileNotFoundError(f"no batches in {root}")
    parts = [
        conform(spark.read.schema(schema).parquet(*paths).withColumn("_path", F.col("_metadata.file_path")))
        for schema, paths in groups
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part, allowMissingColumns=True)
    return combined


def conform(df: DataFrame) -> DataFrame:
    """Contract columns whatever their spelling, widened to the contract types,
    null where a batch lacks one; batch columns from the file name. Columns the
    contract does not know are kept as they are."""
    spelling = {c.lower(): c for c in df.columns}
    known = [
        (F.col(f"`{spelling[c.lower()]}`") if c.lower() in spelling else F.lit(None)).cast(t).alias(c)
        for c, t in TRIP_SOURCE.items()
    ]
    contract = {c.lower() for c in TRIP_SOURCE} | {"_path", "source_year", "source_month", "source_file"}
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() not in contract]
    return df.withColumn("_month", month_of("_path")).select(
        *known,
        *others,
        F.substring("_month", 1, 4).cast("smallint").alias("source_year"),
        F.substring("_month", 6, 2).cast("tinyint").alias("source_month"),
        F.col("_path").alias("source_file"),
    )


def month_of(path: str) -> Column:
    """YYYY-MM of the batch that a file lies in, for every row of it.

    Searching a path for the pattern takes longer than reading the row. What stands
    before the first `.parquet` is the batch wherever it ends in a month; only other
    paths are searched.
    """
    stem = F.substring(F.substring_index(path, ".parquet", 1), -7, 7)
    found = F.concat(F.regexp_extract(path, _BATCH, 2), F.lit("-"), F.regexp_extract(path, _BATCH, 3))
    return F.when(stem.rlike(_MONTH), stem).otherwise(found)


def write_months(trips: DataFrame, root: str) -> None:
    """Lay rows down the way batches land, one folder per month. A month that
    holds most of the rows is spread over several files. A task has the rows of
    few months, so it needs no sort to keep them apart."""
    spread = (
        trips.withColumn(
            "batch",
            F.expr("concat(source_year, '-', lpad(source_month, 2, '0'), '.parquet')"),
        )
        .drop("source_year", "source_month")
        .hint("rebalance", "batch")
    )
    with open_writers(trips.sparkSession):
        spread.write.mode("append").partitionBy("batch").parquet(root)
