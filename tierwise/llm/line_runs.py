"""Repeated runs of lines, by a suffix array over line ids.

DataFrame functions only. Every line is an id, every document a sequence of ids,
and the suffixes of all sequences are ordered by prefix doubling: the bucket of
a suffix for its first 2w lines is the rank of the pair (bucket of its first w
lines, bucket of the w lines after them). Ranks follow the order of the pairs,
so that equal ranks are the intervals of suffixes with a common prefix of that
length, in suffix order. A suffix that is alone in its bucket is settled and
leaves, as nothing longer can repeat it; so do documents' ends and lines that
occur once, which end every run. The rounds stop when no bucket holds two.

Buckets are counted by aggregates that combine before the shuffle, and each
round's tables are stored, so that adaptive execution may split a bucket that a
third of all suffixes share. Nothing is collected but whether a round is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tierwise.llm.common import ASCII_LOWER, ASCII_UPPER, plain_line, read_table, stored, texts

# Lines that a repeated run has at least.
MIN_LINES = 2
# Where a line stands: `at` counts the lines with any word, so that blank ones divide no run; `line` counts all.
PLACE = ["doc_id", "text_hash", "at"]


def line_ids(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text_hash, at and line (both from 0), id (128-bit hash) of every line with any word."""
    lines = F.transform(
        F.split("text", "\n"), lambda s, i: F.struct(i.cast("long").alias("line"), plain_line(s).alias("words"))
    )
    rows = texts(docs, id_column, text_column).select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.filter(lines, lambda s: s["words"] != "")).alias("at", "s"),
    )
    return rows.select(
        "doc_id", "text_hash", F.col("at").cast("long").alias("at"), "s.line", F.unhex(F.md5("s.words")).alias("id")
    ).distinct()


def ranked(pairs: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Ordered ranks of the key values that occur at least twice.

    The ids that Spark gives to the rows of a sorted table increase along it;
    they have gaps, but only their order and equality count.
    """
    repeated = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*keys)
    return stored(repeated.orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()), label)


def followed_by(bucket: DataFrame, after: DataFrame, lines: int, columns: list[Column]) -> DataFrame:
    """Suffixes of `bucket` (h) joined to those of `after` (t) that start `lines` later."""
    h, t = bucket.alias("h"), after.alias("t")
    same = (
        F.col("h.doc_id").eqNullSafe(F.col("t.doc_id"))
        & (F.col("h.text_hash") == F.col("t.text_hash"))
        & (F.col("h.at") + lines == F.col("t.at"))
    )
    return h.join(t, same).select(*(F.col(f"h.{c}") for c in [*PLACE, "line"]), *columns)


def suffix_buckets(lines: DataFrame) -> list[DataFrame]:
    """Tables (doc_id, text_hash, at, line, rank) for prefixes of 1, 2, 4, ... lines;
    only suffixes that share their prefix with another one."""
    names = ranked(lines, ["id"], "line-names")
    now = stored(lines.join(names, "id").select(*PLACE, "line", "rank"), "buckets-1")
    levels, width = [], 1
    while not now.isEmpty():
        levels.append(now)
        both = [F.col("h.rank").alias("head"), F.col("t.rank").alias("next")]
        pairs = stored(followed_by(now, now, width, both), f"pairs-{2 * width}")
        names = ranked(pairs, ["head", "next"], f"names-{2 * width}")
        now = stored(pairs.join(names, ["head", "next"]).select(*PLACE, "line", "rank"), f"buckets-{2 * width}")
        width *= 2
    return levels


def windows(levels: list[DataFrame], min_lines: int) -> DataFrame | None:
    """Every suffix with the interval of its first `min_lines` lines: two
    overlapping prefixes of the largest power of two name it."""
    level = min_lines.bit_length() - 1
    if level >= len(levels):
        return None
    bucket, shift = levels[level], min_lines - (1 << level)
    both = [F.col("h.rank").alias("head"), F.col("t.rank").alias("tail")]
    return followed_by(bucket, bucket, shift, both)


def common_prefix(runs: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """`runs` with matched_lines: the longest common prefix of the suffix at the
    run's start and the one at its source, from long prefixes to short ones."""
    runs = runs.withColumn("matched_lines", F.lit(0).cast("long"))
    for level in range(len(levels) - 1, -1, -1):
        a, b = (levels[level].select(*(F.col(c).alias(f"{side}_{c}") for c in [*PLACE, "rank"])) for side in "ab")
        here = (
            F.col("doc_id").eqNullSafe(F.col("a_doc_id"))
            & (F.col("text_hash") == F.col("a_text_hash"))
            & (F.col("start_at") + F.col("matched_lines") == F.col("a_at"))
        )
        there = (
            F.col("first_doc_id").eqNullSafe(F.col("b_doc_id"))
            & (F.col("first_hash") == F.col("b_text_hash"))
            & (F.col("first_at") + F.col("matched_lines") == F.col("b_at"))
        )
        joined = runs.join(a, here, "left").join(b, there, "left")
        more = F.when(F.col("a_rank") == F.col("b_rank"), 1 << level).otherwise(0)
        runs = joined.select(
            *(F.col(c) for c in runs.columns[:-1]), (F.col("matched_lines") + more).cast("long").alias("matched_lines")
        )
    return runs


EMPTY = T.StructType(
    [T.StructField(c, T.LongType())
     for c in "doc_id text_hash start_line n_lines first_doc_id first_hash first_line matched_lines".split()]
)


def repeated_runs(
    docs: DataFrame, min_lines: int = MIN_LINES, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The runs of lines to delete: doc_id, text_hash, start_line, n_lines,
    first_doc_id, first_hash, first_line, matched_lines.

    A line goes if `min_lines` lines in a row that it is one of occur at an
    earlier place; places are ordered by doc_id (null last), text and line, and
    the run of all such lines next to each other is one row. Its source is the
    earliest place where its first `min_lines` lines stand; matched_lines tells
    how many lines it goes on like its source. Lines are equal if they are after
    lower-casing A-Z and collapsing ASCII white space. Blank lines count neither
    as lines in a row nor as matched; those inside a run are part of its n_lines.
    Rows that repeat doc_id and text count once and share their fate. Null and
    empty texts have no line; an empty table gives no row; other columns are
    not read.
    """
    levels = suffix_buckets(stored(line_ids(docs, id_column, text_column), "lines"))
    found = windows(levels, min_lines)
    if found is None:
        return docs.sparkSession.createDataFrame([], EMPTY)
    if min_lines & (min_lines - 1):
        found = stored(found, "windows")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), *PLACE, "line")
    first = stored(
        found.select("head", "tail", place.alias("place")).groupBy("head", "tail").agg(F.min("place").alias("first")),
        "run-firsts",
    )
    later = found.join(first, ["head", "tail"]).where(place > F.col("first"))
    in_text = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    begins = F.coalesce(F.col("at") > F.lag("at").over(in_text) + min_lines, F.lit(True))
    numbered = later.withColumn("begins", begins.cast("int")).withColumn(
        "run", F.sum("begins").over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = numbered.groupBy("doc_id", "text_hash", "run").agg(
        F.min("line").alias("start_line"),
        F.min("at").alias("start_at"),
        (F.max("at") + min_lines - 1).alias("end_at"),
        F.min(F.when(F.col("begins") == 1, F.col("first"))).alias("first"),
    )
    r, last = runs.alias("r"), levels[0].alias("last")  # every line of a run is a repeated one
    ends = (
        F.col("r.doc_id").eqNullSafe(F.col("last.doc_id"))
        & (F.col("r.text_hash") == F.col("last.text_hash"))
        & (F.col("r.end_at") == F.col("last.at"))
    )
    placed = r.join(last, ends).select(
        "r.doc_id", "r.text_hash", "start_line", (F.col("last.line") - F.col("start_line") + 1).alias("n_lines"),
        F.col("first.doc_id").alias("first_doc_id"), F.col("first.text_hash").alias("first_hash"),
        F.col("first.line").alias("first_line"), "start_at", F.col("first.at").alias("first_at"),
    )
    return common_prefix(stored(placed, "runs"), levels).drop("start_at", "first_at")


def drop_repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES) -> DataFrame:
    """`docs` without the lines of repeated runs.

    Every row stays, with all its columns; null and empty texts and those without a
    repeated run are as they were. Rows that repeat doc_id and text, a null id as
    well, lose the same lines. An empty table stays one.
    """
    gone = (
        repeated_runs(docs, min_lines)
        .groupBy(F.col("doc_id").alias("cut_id"), F.col("text_hash").alias("cut_hash"))
        .agg(F.collect_set(F.struct("start_line", "n_lines")).alias("cuts"))
    )
    text = F.coalesce(docs["text"], F.lit(""))
    same = docs["doc_id"].cast("long").eqNullSafe(gone["cut_id"]) & (F.xxhash64(text) == gone["cut_hash"])
    kept = F.filter(
        F.split(docs["text"], "\n"),
        lambda _, i: ~F.exists(
            gone["cuts"], lambda r: (i >= r["start_line"]) & (i < r["start_line"] + r["n_lines"])
        ),
    )
    columns = [
        F.when(gone["cuts"].isNull(), docs["text"]).otherwise(F.array_join(kept, "\n")).alias("text")
        if c == "text"
        else docs[c]
        for c in docs.columns
    ]
    return docs.join(gone, same, "left").select(*columns)


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_runs(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start_line", "n_lines", "first_doc_id", "first_line", "matched_lines")


def _op10_sql() -> str:
    window = " || chr(10) || ".join(["norm", *(f"lead(norm, {i}) OVER place" for i in range(1, MIN_LINES))])
    return f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS raw,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM documents),
normal AS (
  SELECT doc_id, line, trim(regexp_replace(translate(raw, '{ASCII_UPPER}', '{ASCII_LOWER}'),
                                           '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') AS norm FROM lines),
plain AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) - 1 AS spot FROM normal WHERE norm <> ''),
windowed AS (
  SELECT doc_id, line, spot, {window} AS win FROM plain WINDOW place AS (PARTITION BY doc_id ORDER BY spot)),
first AS (
  SELECT *, first_value(doc_id) OVER same AS fdoc, first_value(line) OVER same AS fline, first_value(spot) OVER same AS fat,
         row_number() OVER same AS nth FROM windowed WHERE win IS NOT NULL
  WINDOW same AS (PARTITION BY win ORDER BY doc_id, spot)),
later AS (
  SELECT *, coalesce(spot > lag(spot) OVER t + {MIN_LINES}, true) AS begins FROM first WHERE nth > 1
  WINDOW t AS (PARTITION BY doc_id ORDER BY spot)),
numbered AS (
  SELECT *, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY spot) AS run FROM later),
runs AS (
  SELECT doc_id, min(line) AS start_line, min(spot) AS start_at, max(spot) + {MIN_LINES} - 1 AS end_at,
         arg_min(fdoc, spot) AS fdoc, arg_min(fline, spot) AS fline, arg_min(fat, spot) AS fat FROM numbered GROUP BY doc_id, run),
compared AS (
  SELECT r.doc_id, r.start_at, min(CASE WHEN b.norm IS NULL OR a.norm <> b.norm THEN a.spot END) AS differs, max(a.spot) AS last
  FROM runs r JOIN plain a ON a.doc_id = r.doc_id AND a.spot >= r.start_at
  LEFT JOIN plain b ON b.doc_id = r.fdoc AND b.spot = r.fat + a.spot - r.start_at
  GROUP BY ALL)
SELECT r.doc_id, CAST(r.start_line AS BIGINT) AS start_line, CAST(e.line - r.start_line + 1 AS BIGINT) AS n_lines,
       r.fdoc AS first_doc_id, CAST(r.fline AS BIGINT) AS first_line,
       CAST(coalesce(c.differs, c.last + 1) - r.start_at AS BIGINT) AS matched_lines
FROM runs r JOIN compared c ON r.doc_id = c.doc_id AND r.start_at = c.start_at
JOIN plain e ON e.doc_id = r.doc_id AND e.spot = r.end_at
"""


OP10_SQL = _op10_sql()
