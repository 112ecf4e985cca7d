"""Exact duplicates: a 128-bit content hash, then the bytes themselves.

DataFrame functions only. Grouping on (hash, text) lets Spark place rows by
hash and text, combine copies before the shuffle, and compare whole texts, so a
collision of the hash never merges two texts. What leaves the grouping has no
text any more; it is joined to the documents by MD5 and SHA-256 together.
A group of any size is one row there, and adaptive execution splits the
documents' side of the join where a group is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import read_table, stored, texts


def one_space(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " ")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are after replacing each run of ASCII white space by
    one space; null counts as empty, and so do all empty texts as one group.
    keep_id is the smallest doc_id of the group. Rows that repeat a doc_id share
    its fate. A null doc_id never stays beside a number; a group without any
    number has a null keep_id and keeps all its rows, as nothing tells them
    apart. An empty table gives an empty result; other columns are not read.
    """
    rows = texts(docs, id_column, text_column).select("doc_id", one_space(F.col("text")).alias("norm"))
    hashed = rows.select(
        "doc_id", "norm", F.unhex(F.md5("norm")).alias("h"), F.sha2("norm", 256).alias("text_sha256")
    )
    groups = (
        hashed.groupBy("h", "norm")
        .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("h", F.sha2("norm", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    members = hashed.select("doc_id", "h", "text_sha256")
    return members.join(groups, ["h", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), "text_sha256"
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with the columns they had.

    A row goes if its doc_id and its text both belong to a row that does not stay.
    Null and empty texts are equal to each other, and one of them stays. Rows that
    repeat the doc_id and the text of the row that stays are that row, and stay with
    it; so do rows without a doc_id where no equal row has one. An empty table stays one.
    """
    marked = exact_duplicates(docs).where(~F.col("kept"))
    gone = stored(marked.select("doc_id", "text_sha256").distinct(), "exact-gone")
    digest = F.sha2(one_space(F.coalesce(docs["text"], F.lit(""))), 256)
    same = docs["doc_id"].cast("long").eqNullSafe(gone["doc_id"]) & (digest == gone["text_sha256"])
    return docs.join(gone, same, "left_anti")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


OP6_SQL = """
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS norm FROM documents)
WINDOW same AS (PARTITION BY norm)
"""
