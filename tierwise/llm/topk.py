"""Exact top-k inner products by a bit-sliced index.

Vectors are turned into integers and kept in blocks of rows. For the search a
block's attributes are quantised to their upper bits and stored as bit slices:
bit b of attribute d of all rows is one bitmap. A query adds the slices, each as
often as the bits of its weight say, with bitmap adders that turn three bitmaps
of a place into one of that place and one carry. The sums are bit slices again,
and rows are selected from the most significant slice downward. Every row whose
true score could still be among the best, given the lower bits left out, is then
scored exactly with its whole integers; nothing else is.

Queries and rows meet as blocks, and a pair of blocks gives k rows per query at
most, which a ranking window cuts down before it shuffles them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierwise.llm.common import batches_of, bounded_batches, read_table, stored

SCALE = 1024
K = 10
QUERY_STEP = 100
# Rows and queries in one block, 8 MB and 32 kB at 64 attributes, and pairs of
# blocks that a worker receives at once. An adder works on whole bitmaps, so it
# pays if they are long.
ROWS_IN_BLOCK = 32_768
QUERIES_IN_BLOCK = 128
PAIRS_IN_BATCH = 4
# Bits of an attribute that are kept in slices.
SLICE_BITS = 6

BLOCK = "ids binary, cells binary, width int"


def scaled(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """vec_id and floor(scale * component) of every whole, finite vector."""
    numbers = vectors[vector_column].cast("array<double>")
    usable = numbers.isNotNull() & F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return vectors.where(usable & vectors[id_column].isNotNull()).select(
        vectors[id_column].cast("long").alias("vec_id"),
        F.transform(numbers, lambda x: F.floor(F.lit(float(scale)) * x)).alias("cells"),
    )


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """`rows` packed into blocks of up to `size`: their ids and a matrix of
    integers, shorter vectors filled with zeros."""

    def pack(ids: list[int], cells: list[list[int]]) -> pa.RecordBatch:
        width = max(map(len, cells))
        matrix = np.zeros((len(cells), width), np.int64)
        for row, values in zip(matrix, cells, strict=True):
            row[: len(values)] = values
        if np.abs(matrix).max(initial=0) < 1 << 31:
            matrix = matrix.astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array([np.array(ids, np.int64).tobytes()], pa.binary()), pa.array([matrix.tobytes()], pa.binary()),
             pa.array([width], pa.int32())], ["ids", "cells", "width"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int] = []
        cells: list[list[int]] = []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            cells += batch.column("cells").to_pylist()
            while len(ids) >= size:
                yield pack(ids[:size], cells[:size])
                ids, cells = ids[size:], cells[size:]
        if ids:
            yield pack(ids, cells)

    return rows.mapInArrow(run, BLOCK)


class BitSlicedIndex:
    """The rows of one block as bit slices of their quantised attributes.

    Slices are numpy arrays of 64-bit words, one bit per row.
    """

    def __init__(self, ids: np.ndarray, cells: np.ndarray, bits: int = SLICE_BITS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.cells = ids[order], cells[order]
        self.rows = len(ids)
        least = self.cells.min(axis=0)
        spread = int((self.cells.max(axis=0) - least).max()) if self.cells.size else 0
        self.dropped = max(0, spread.bit_length() - bits)
        self.least = least
        quantised = (self.cells - least) >> self.dropped
        self.bits = max(1, int(quantised.max()).bit_length()) if quantised.size else 1
        self.slices = [[self._bitmap(column >> b & 1) for b in range(self.bits)] for column in quantised.T]
        self.all = self._bitmap(np.ones(self.rows, np.int64))

    def _bitmap(self, flags: np.ndarray) -> np.ndarray:
        packed = np.packbits(flags.astype(np.uint8), bitorder="little")
        return np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view(np.uint64)

    def rows_in(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=self.rows, bitorder="little"))

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices, least significant first, of the quantised score: the sum over
        attributes of |weight| times the attribute, or times its complement to
        the largest value where the weight is negative."""
        places: list[list[np.ndarray]] = []

        def put(place: int, bitmap: np.ndarray) -> None:
            while len(places) <= place:
                places.append([])
            places[place].append(bitmap)

        for weight, slices in zip(query.tolist(), self.slices, strict=True):
            for shift in range(abs(weight).bit_length()):
                if abs(weight) >> shift & 1:
                    for b, bitmap in enumerate(slices):
                        put(shift + b, bitmap if weight > 0 else bitmap ^ self.all)
        out, place = [], 0
        while place < len(places):
            waiting = places[place]
            while len(waiting) > 2:
                a, b, c = waiting.pop(), waiting.pop(), waiting.pop()
                either = a ^ b
                waiting.append(either ^ c)
                put(place + 1, (a & b) | (either & c))
            if len(waiting) == 2:
                a, b = waiting.pop(), waiting.pop()
                waiting.append(a ^ b)
                put(place + 1, a & b)
            out.append(waiting[0] if waiting else np.zeros_like(self.all))
            place += 1
        return out

    def candidates(self, sums: list[np.ndarray], among: np.ndarray, k: int, slack: int) -> np.ndarray:
        """Bitmap of the rows of `among` whose sum is at most `slack` below the k-th largest."""

        def count(bitmap: np.ndarray) -> int:
            return int(np.bitwise_count(bitmap).sum())

        if count(among) <= k:
            return among
        above, equal, kth = np.zeros_like(among), among, 0
        for place in range(len(sums) - 1, -1, -1):
            kth <<= 1
            ones = equal & sums[place]
            if count(above) + count(ones) >= k:  # the k-th largest has this bit
                equal, kth = ones, kth | 1
            else:
                above, equal = above | ones, equal & ~sums[place]
        bound = max(0, kth - slack)
        above, equal = np.zeros_like(among), among
        for place in range(len(sums) - 1, -1, -1):
            if bound >> place & 1:
                equal = equal & sums[place]
            else:
                above, equal = above | (equal & sums[place]), equal & ~sums[place]
        return above | equal

    def top(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, ties to the smaller id; without the query's own."""
        own = slice(*np.searchsorted(self.ids, [query_id, query_id + 1]))
        among = self.all
        if own.start < own.stop:
            flags = np.zeros(self.rows, np.int64)
            flags[own] = 1
            among = self.all & ~self._bitmap(flags)
        # Queries and rows of different widths meet on what both have.
        width = min(len(query), self.cells.shape[1])
        weights = np.zeros(self.cells.shape[1], np.int64)
        weights[:width] = query[:width]
        # Between a row's lower bits all zero and all one lies this much.
        slack = (int(np.abs(weights).sum()) * ((1 << self.dropped) - 1) >> self.dropped) + 1 if self.dropped else 0
        rows = self.rows_in(self.candidates(self.sums(weights), among, k, slack))
        scores = self.exact(rows, weights)
        best = np.lexsort((rows, -scores))[:k]
        return self.ids[rows[best]], scores[best]

    def exact(self, rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
        chosen = self.cells[rows]
        largest = int(np.abs(chosen).max(initial=0)) * int(np.abs(weights).sum())
        if largest < 1 << 53:  # exact in doubles, whose product is the fast one
            return (chosen.astype(np.float64) @ weights.astype(np.float64)).astype(np.int64)
        return chosen @ weights


def _matrix(cells: bytes, width: int, rows: int) -> np.ndarray:
    kind = np.int32 if len(cells) == 4 * rows * width else np.int64
    return np.frombuffer(cells, kind).reshape(rows, width).astype(np.int64)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """The k rows of largest integer inner product for every row where `is_query`
    holds: query_id, rank, vec_id, score.

    Vectors that are null or hold a null, NaN or infinite component take no part,
    nor do rows without an id; an empty vector scores 0 with all. Vectors of
    different lengths meet on the components both have. All rows with the
    query's id are its own; of rows that repeat another id, each counts. Ties go
    to the smaller id; a query with fewer than k other rows returns them all.
    `is_query` speaks of the column `vec_id`. Scores must fit 64 bits. An empty
    table gives no row; other columns are not read.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = scaled(vectors, id_column, vector_column, scale)
    dealt = rows.repartition(max(1, -(-vectors.count() // ROWS_IN_BLOCK)))
    data = stored(blocks(dealt, ROWS_IN_BLOCK), "vector-blocks")
    # A query id that is repeated asks once, with its first vector in order.
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("cells").alias("cells"))
    asking = stored(blocks(asked, QUERIES_IN_BLOCK), "query-blocks")
    # Blocks against blocks: a stated set of queries against all rows.
    pairs = data.crossJoin(asking.select(*(F.col(c).alias(f"q_{c}") for c in asking.columns)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index = None, None
        for batch in batches:
            for ids, cells, width, q_ids, q_cells, q_width in zip(
                *(batch.column(i).to_pylist() for i in range(6)), strict=True
            ):
                ids, q_ids = np.frombuffer(ids, np.int64), np.frombuffer(q_ids, np.int64)
                if last != (cells, width):  # pairs of one block of rows come together
                    last, index = (cells, width), BitSlicedIndex(ids, _matrix(cells, width, len(ids)))
                found = [
                    (query_id, *index.top(query_id, query, k))
                    for query_id, query in zip(q_ids.tolist(), _matrix(q_cells, q_width, len(q_ids)), strict=True)
                ]
                query = np.concatenate([np.full(len(near), q) for q, near, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(np.concatenate([f[1] for f in found]), pa.int64()),
                     pa.array(np.concatenate([f[2] for f in found]), pa.int64())], ["query_id", "vec_id", "score"],
                )

    with batches_of(spark, PAIRS_IN_BATCH):
        found = stored(pairs.mapInArrow(run, "query_id long, vec_id long, score long"), "block-bests")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


OP2_SQL = f"""
WITH scaled AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS cells
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id,
         CAST(list_sum(list_transform(list_zip(q.cells, r.cells), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM scaled q JOIN scaled r ON q.vec_id <> r.vec_id WHERE q.vec_id % {QUERY_STEP} = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
