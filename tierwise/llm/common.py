"""What the operators on documents share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.session import fresh_dir

# Rows of text in one Arrow batch. Documents reach 100 kB and more, and Spark's
# 10,000 rows of them would be a gigabyte in the worker's memory at once.
ROWS_PER_BATCH = 512

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def bounded_batches(spark: SparkSession, rows: int = ROWS_PER_BATCH) -> None:
    """Lower the session's limit of rows in an Arrow batch, if it is above."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of `rows` rows for what runs inside, and as before after it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only id and text, whatever else the table has; a null text is empty."""
    return docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
    )


def plain_line(text: Column) -> Column:
    """A line as it is compared: A-Z lower-cased, ASCII white space collapsed and trimmed."""
    lowered = F.translate(text, ASCII_UPPER, ASCII_LOWER)
    return F.btrim(F.regexp_replace(lowered, "[\\x20\\x09-\\x0D]+", " "), F.lit(" "))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: what follows does not repeat
    the work, survives the loss of any executor, and joins of two such tables
    shuffle both sides, so that adaptive execution can split hot keys."""
    path = fresh_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of every batch that has rows."""
    for batch in batches:
        if batch.num_rows:
            yield batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
