"""Fill-in-the-middle: documents cut in three at unit boundaries and put in another order.

A unit is a run of ASCII letters or any other character. Where the k-th unit of a
text ends is read from a learned rank index over all boundaries of a batch: straight
segments, fitted so that none misses a boundary by more than a bound, predict the
offset of a rank, and the residual stored for that rank, one byte, corrects it exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import bounded_batches, read_table, rows_of, texts

# What marks the parts, and how many of a hundred documents stay plain or get the suffix first.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SUFFIX_FIRST_BELOW = 90, 20
SEED = "1:"
# A segment's error at most, so that residuals are bytes, and its ranks at first.
ERROR, SEGMENT = 127, 1 << 13
# Code points whose boundaries are indexed together; a longer text is one by itself.
CHARS_TOGETHER = 1 << 21

OUTPUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


class RankIndex:
    """Increasing offsets by rank, as straight segments and one byte a rank."""

    def __init__(self, offsets: np.ndarray):
        n = len(offsets)
        first = np.arange(0, n, SEGMENT)
        last = np.minimum(first + SEGMENT, n) - 1
        self.residuals = np.zeros(n, np.int8)
        found: list[np.ndarray] = []
        while len(first):
            sizes = last - first + 1
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            ranks = np.arange(sizes.sum()) + np.repeat(first - begins, sizes)
            base, rise, run = offsets[first], offsets[last] - offsets[first], np.maximum(last - first, 1)
            missed = offsets[ranks] - self._line(ranks, *(np.repeat(x, sizes) for x in (first, base, rise, run)))
            fits = np.maximum.reduceat(np.abs(missed), begins) <= ERROR
            held = np.repeat(fits, sizes)
            self.residuals[ranks[held]] = missed[held]
            found.append(np.stack([first, base, rise, run])[:, fits])
            # The rest is cut in halves; a segment of two ranks has no error.
            first, last = first[~fits], last[~fits]
            half = (first + last) // 2
            first, last = np.concatenate([first, half + 1]), np.concatenate([half, last])
        segments = np.concatenate(found, axis=1)
        self.segments = segments[:, np.argsort(segments[0])]

    @staticmethod
    def _line(ranks: np.ndarray, first: np.ndarray, base: np.ndarray, rise: np.ndarray, run: np.ndarray) -> np.ndarray:
        return base + (ranks - first) * rise // run

    def select(self, ranks: np.ndarray) -> np.ndarray:
        """The offsets of these ranks."""
        place = np.searchsorted(self.segments[0], ranks, side="right") - 1
        return self._line(ranks, *self.segments[:, place]) + self.residuals[ranks]


def boundaries(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """0 and every offset at which a unit ends; `points` are the code points of
    texts one after the other, `ends` where each of them ends."""
    letter = (points | 32) - np.uint32(97) < 26
    ended = np.ones(len(points) + 1, bool)
    ended[1:-1] = ~(letter[:-1] & letter[1:])
    ended[ends] = True
    return np.flatnonzero(ended)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """Four numbers below 2^32 that depend on the id alone; a null id draws as an empty one."""
    digest = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[at : at + 8], 16) for at in range(0, 32, 8))


def split(ids: list[int | None], batch: list[str]) -> Iterator[tuple[int, int, int]]:
    """Units of every text, and the offsets at which its prefix and its middle end."""
    points = np.frombuffer("".join(batch).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(text) for text in batch])
    starts = ends - [len(text) for text in batch]
    offsets = boundaries(points, ends)
    index = RankIndex(offsets)
    low = np.searchsorted(offsets, starts)
    units = np.searchsorted(offsets, ends) - low
    numbers = np.array([draws(i)[:2] for i in ids], np.int64).reshape(-1, 2)
    cuts = np.sort(numbers % (units + 1)[:, None], axis=1)
    places = index.select((low[:, None] + cuts).ravel()).reshape(-1, 2) - starts[:, None]
    return zip(units.tolist(), *places.T.tolist(), strict=True)


def arranged(doc_id: int | None, text: str, first: int, second: int) -> tuple[str, int | None, int | None, str]:
    """Form, characters of prefix and middle, and output for cuts at `first` and `second`."""
    _, _, third, fourth = draws(doc_id)
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or third % 100 >= PLAIN_FROM:
        return "plain", None, None, text
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if fourth % 100 < SUFFIX_FIRST_BELOW:
        return "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def together(ids: list, batch: list[str]) -> Iterator[tuple[list, list[str]]]:
    """The batch in runs of texts of bounded size."""
    begin = size = 0
    for at, text in enumerate(batch):
        if size and size + len(text) > CHARS_TOGETHER:
            yield ids[begin:at], batch[begin:at]
            begin, size = at, 0
        size += len(text)
    yield ids[begin:], batch[begin:]


def transform(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output, one row per row of `docs`.

    Cuts and form depend on the id and the number of units alone, so rows that
    repeat an id and a text have equal outputs, and so has every row without an id
    and with that text. A null text is empty; empty texts, and texts that hold a
    mark, are plain, with null for both counts. An empty table gives no row; other
    columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            for ids, batch in together(*rows):
                cuts = list(split(ids, batch))
                made = [arranged(i, text, a, b) for i, text, (_, a, b) in zip(ids, batch, cuts, strict=True)]
                form, prefix, middle, output = zip(*made, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array([c[0] for c in cuts], pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return texts(docs, id_column, text_column).mapInArrow(run, OUTPUT)


def restored(output: Column, form: Column) -> Column:
    """The exact text again: a text that holds a mark is plain, and no mark can begin
    inside another, so the marks of an output stand where they were put."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = transform(read_table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


_HASHED = ", ".join(
    f"CAST('0x' || substr(sha256('{SEED}' || doc_id), {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}" for i in range(4)
)

OP12_SQL = f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         {_HASHED} FROM documents),
placed AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '{PREFIX}') OR contains(text, '{SUFFIX}') OR contains(text, '{MIDDLE}')
                OR h3 % 100 >= {PLAIN_FROM} THEN 'plain'
              WHEN h4 % 100 < {SUFFIX_FIRST_BELOW} THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix FROM placed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'spm' THEN '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle
                        ELSE '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
