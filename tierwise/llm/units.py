"""Repeated lines, sentences or paragraphs: every passage stays once in the corpus.

Texts are cut into units, by default at line breaks and at the ends of sentences,
for a passage that documents share need not begin or end with a line. Units are
normalised and hashed where the text is read; only digests and offsets are
shuffled, of every unit that has a word. The earliest occurrence of a digest is an
aggregate that combines before the shuffle, so a line that a third of all documents
share is one row per task there. Both sides of the join back are stored tables,
which lets adaptive execution split the rows of such a line over many tasks.

Short units recur by chance, so length is judged afterwards: what goes are
stretches of neighbouring repeated units that have enough words together.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwise.llm.common import ASCII_LOWER, ASCII_UPPER, bounded_batches, read_table, stored, texts

LINE, PARAGRAPH = r"\n", r"\n(?:[ \t\r]*\n)+"
SENTENCE = r"[.!?][\x20\x09\x0B-\x0D]+|\n"
# Words that neighbouring repeated units must have together to go. Greetings,
# headings and other short lines that stand alone are shared by documents that
# copy nothing from each other.
MIN_WORDS = 20
# Units of fewer words go along with their stretch but don't add to it: single
# words between marks recur in any order, in shouting or in lists.
COUNTED_FROM = 3

UNITS = "doc_id long, text_hash long, unit long, start long, end long, n_words long, digest binary"


def unit_rows(
    docs: DataFrame, unit_end: str = SENTENCE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per unit with a word: its number among those of its text, and its
    place in code points. A unit takes along what ends it."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = re.compile(unit_end)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text, text_hash in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                start = unit = 0
                ends = [m.end() for m in between.finditer(text)]
                for end in (*ends, len(text)):
                    words = text[start:end].encode("utf-8", "replace").lower().split()
                    if words:
                        digest = hashlib.md5(b" ".join(words), usedforsecurity=False).digest()
                        rows.append((doc_id, text_hash, unit, start, end, len(words), digest))
                        unit += 1
                    start = end
            if rows:
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:6]), pa.array(columns[6], pa.binary())],
                    ["doc_id", "text_hash", "unit", "start", "end", "n_words", "digest"],
                )

    rows = texts(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))
    return rows.mapInArrow(run, UNITS)


def repeated_units(
    docs: DataFrame, min_words: int = MIN_WORDS, unit_end: str = SENTENCE, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The units to remove: doc_id, text_hash, unit, start, end, n_words, keep_doc_id, keep_start.

    Units are equal if they are after lower-casing A-Z and collapsing ASCII
    white space; the one with the smallest (doc_id, start) stays, also within
    one document, and a null doc_id ranks last. The others go where they and
    the units next to them that may go have `min_words` words or more together;
    what has no word between them does not count. Rows that repeat doc_id and text
    hold the same occurrences and share their fate. Null, empty and blank texts
    have no unit. An empty table gives no row; other columns are not read.
    """
    units = stored(unit_rows(docs, unit_end, id_column, text_column), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash", "start")
    occurrences = units.select("digest", rank.alias("rank"))
    firsts = stored(
        occurrences.groupBy("digest")
        .agg(F.min("rank").alias("first"), F.max("rank").alias("last"))
        .where("first < last")
        .select("digest", "first"),
        "unit-firsts",
    )
    later = units.join(firsts, "digest").where(rank != F.col("first"))
    # Stretches of later occurrences; a step of 0 is the same unit of a repeated row.
    text = ["doc_id", "text_hash"]
    in_order = Window.partitionBy(*text).orderBy("unit")
    step = F.col("unit") - F.lag("unit").over(in_order)
    begins = F.coalesce((F.col("step") > 1).cast("int"), F.lit(1))
    stretches = later.withColumn("step", step).withColumn(
        "stretch", F.sum(begins).over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    once = F.when((F.coalesce(F.col("step"), F.lit(1)) > 0) & (F.col("n_words") >= COUNTED_FROM), F.col("n_words"))
    together = F.coalesce(F.sum(once).over(Window.partitionBy(*text, "stretch")), F.lit(0))
    return (
        stretches.withColumn("together", together)
        .where(F.col("together") >= min_words)
        .select(
            "doc_id", "text_hash", "unit", "start", "end", "n_words",
            F.col("first.doc_id").alias("keep_doc_id"), F.col("first.start").alias("keep_start"),
        )
    )


def drop_repeated_units(docs: DataFrame, min_words: int = MIN_WORDS, unit_end: str = SENTENCE) -> DataFrame:
    """`docs` with the repeated units cut out of `text`, and `removed_spans`, an
    array of their original (start, end).

    Every row stays, with all its columns; a text of which nothing goes is as it
    was, null too, and has null spans. Rows that repeat doc_id and text, a null id
    as well, lose the same spans. An empty table stays one.
    """
    removed = (
        repeated_units(docs, min_words, unit_end)
        .groupBy(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"))
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("removed_spans"))
    )
    text = F.coalesce(docs["text"], F.lit(""))
    same = docs["doc_id"].cast("long").eqNullSafe(removed["cut_id"]) & (F.xxhash64(text) == removed["cut_hash"])
    spans = removed["removed_spans"]
    edges = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    kept = F.transform(
        edges,
        lambda e, i: F.substring(
            docs["text"],
            (e + 1).cast("int"),
            (F.coalesce(F.get(spans, i)["start"], F.length(docs["text"]).cast("long")) - e).cast("int"),
        ),
    )
    columns = [
        F.when(spans.isNotNull(), F.array_join(kept, "")).otherwise(docs["text"]).alias("text") if c == "text" else docs[c]
        for c in docs.columns
    ]
    return docs.join(removed, same, "left").select(*columns, spans)


def op9_line_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_units(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "unit", "start", "end", "n_words", "keep_doc_id", "keep_start")


_CUT = (
    f"string_split(regexp_replace(coalesce(text, ''), '({SENTENCE})', '\\1' || chr(1), 'g'), chr(1))"  # chr(1) is in no table
)

OP9_SQL = f"""
WITH pieces AS (
  SELECT doc_id, unnest({_CUT}) AS piece, generate_subscripts({_CUT}, 1) AS place FROM documents),
placed AS (
  SELECT *, coalesce(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY place
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
         trim(regexp_replace(translate(piece, '{ASCII_UPPER}', '{ASCII_LOWER}'),
                             '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS norm FROM pieces),
units AS (
  SELECT *, len(string_split(norm, ' ')) AS n_words,
         row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS unit FROM placed WHERE norm <> ''),
ranked AS (
  SELECT *, first_value(doc_id) OVER same AS keep_doc_id, first_value(start) OVER same AS keep_start,
         row_number() OVER same AS nth
  FROM units WINDOW same AS (PARTITION BY norm ORDER BY doc_id, start)),
later AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id ORDER BY unit) AS stretch FROM ranked WHERE nth > 1),
weighed AS (
  SELECT *, sum(CASE WHEN n_words >= {COUNTED_FROM} THEN n_words END) OVER (PARTITION BY doc_id, stretch) AS together
  FROM later)
SELECT doc_id, CAST(unit AS BIGINT) AS unit, CAST(start AS BIGINT) AS start,
       CAST(start + length(piece) AS BIGINT) AS "end", CAST(n_words AS BIGINT) AS n_words,
       keep_doc_id, CAST(keep_start AS BIGINT) AS keep_start
FROM weighed WHERE together >= {MIN_WORDS}
"""
