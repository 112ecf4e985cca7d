"""Ranked lexical search: the best documents of every item by integer BM25 scores.

Documents are read once per block of items: a worker counts each text's terms and
keeps those of the block. Lists of documents by term are then built over some ten
thousand documents at a time, and every item is searched in each by a hybrid of
both classic orders. Its short lists are summed term at a time into accumulators;
these, sorted by document and with a bound of their scores, count as one more list
beside the long ones, and all of them are searched document at a time: windows of
documents whose bounds can't reach the item's worst kept score are skipped, and in
the others, documents found only in lists of too small a bound are never scored.
The worst kept score is handed on from part to part. Only an item's best rows of
each task are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwise.llm.common import ASCII_LOWER, ASCII_UPPER, bounded_batches, read_table, rows_of, stored, texts

TOP = 50
# Terms of the items of one block, about: what a worker knows of the items at once.
BLOCK_TERMS = 200_000
# Postings and documents of one part at most, documents of one window, and documents
# of the part for one of a list that is still short.
POSTINGS, DOCUMENTS, WINDOW, SHORT = 1 << 22, 1 << 16, 1 << 10, 64
# Fixed values of the score: saturation and length, in thousandths and hundredths.
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_SHARE = 1_000_000_000, 1000, 20, 50

# ASCII as terms see it: letters lower-cased, digits as they are, the rest a space.
_PLAIN = bytes(
    b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return text.encode("utf-8", "replace").translate(_PLAIN).split(b" ")


def words(text: str) -> list[bytes]:
    return [t for t in terms(text) if t]


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


# --- counting ------------------------------------------------------------------


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms), terms, tfs: numbers and counts of the terms in `vocabulary`;
    rows without any term are left out."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, batch in rows_of(batches):
            kept, sizes, ends, numbers, tfs = [], [], [0], [], []
            for doc_id, text in zip(ids, batch, strict=True):
                found = Counter(terms(text))
                found.pop(b"", None)
                if found:
                    known = [(vocabulary[t], tf) for t, tf in found.items() if t in vocabulary]
                    kept.append(doc_id)
                    sizes.append(found.total())
                    numbers += [k[0] for k in known]
                    tfs += [k[1] for k in known]
                    ends.append(len(numbers))
            if kept:
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(numbers, pa.int32())),
                     pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


# --- searching one part -----------------------------------------------------------


class Best:
    """The best documents of an item so far, best first: score, then smaller id, null last."""

    def __init__(self, top: int):
        self.top = top
        self.scores, self.ids, self.nameless = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def floor(self) -> int:
        """A document below this score is not among them."""
        return int(self.scores[-1]) if len(self.scores) == self.top else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nameless: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        nameless = np.concatenate([self.nameless, nameless])
        order = np.lexsort((ids, nameless, -scores))[: self.top]
        self.scores, self.ids, self.nameless = scores[order], ids[order], nameless[order]


class Part:
    """Lists by term over some documents, which are numbered in the order of their ids."""

    def __init__(self, ids, nameless, sizes, ends, numbers, tfs, weights, documents, length):
        order = np.lexsort((ids, nameless))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, self.nameless, self.count = ids[order], nameless[order], len(ids)
        doc = np.repeat(place, np.diff(ends))
        norm = 100 - LENGTH_SHARE + LENGTH_SHARE * sizes * documents // length
        impact = weights[numbers] * (SCALE * tfs // (TF_SCALE * tfs + LENGTH_SCALE * np.repeat(norm, np.diff(ends))))
        by_term = np.lexsort((doc, numbers))
        self.docs, self.impacts = doc[by_term], impact[by_term]
        self.begins = np.searchsorted(numbers[by_term], np.arange(len(weights) + 1))
        self.edges = np.arange(0, self.count + WINDOW, WINDOW)
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def windows(self, docs: np.ndarray, impacts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each window begins in a list, and its greatest score there."""
        cut = np.searchsorted(docs, self.edges)
        most = np.zeros(len(self.edges) - 1, np.int64)
        filled = cut[1:] > cut[:-1]
        if filled.any():
            most[filled] = np.maximum.reduceat(impacts, cut[:-1][filled])
        return cut, most

    def search(self, item: list[int], best: Best) -> None:
        spans = [(int(self.begins[t]), int(self.begins[t + 1]), t) for t in item]
        short = [s for s in spans if 0 < s[1] - s[0] <= self.count // SHORT]
        lists = []
        if short:  # term at a time
            docs = np.concatenate([self.docs[a:b] for a, b, _ in short])
            docs, inverse = np.unique(docs, return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, inverse, np.concatenate([self.impacts[a:b] for a, b, _ in short]))
            lists.append((docs, sums, *self.windows(docs, sums)))
        for a, b, t in spans:
            if b - a > self.count // SHORT:
                if t not in self.bounds:
                    self.bounds[t] = self.windows(self.docs[a:b], self.impacts[a:b])
                lists.append((self.docs[a:b], self.impacts[a:b], *self.bounds[t]))
        if not lists:
            return
        # Document at a time: in the order of documents, a window of them together.
        most = np.stack([x[3] for x in lists])
        for window in np.flatnonzero(most.sum(axis=0) >= best.floor).tolist():
            bounds = most[:, window]
            if bounds.sum() >= best.floor:
                self._window(lists, window, bounds, best)

    def _window(self, lists: list, window: int, bounds: np.ndarray, best: Best) -> None:
        floor, base = best.floor, int(self.edges[window])
        order = np.argsort(-bounds, kind="stable")
        rest = np.cumsum(bounds[order][::-1])[::-1].tolist()  # bound of a list and all after it
        scores = np.zeros(min(WINDOW, self.count - base), np.int64)
        found = None
        for at, k in enumerate(order.tolist()):
            docs, impacts, cut, _ = lists[k]
            docs, impacts = docs[cut[window] : cut[window + 1]] - base, impacts[cut[window] : cut[window + 1]]
            if not len(docs):
                break
            if found is None and rest[at] >= floor:  # its documents may still be new ones
                scores[docs] += impacts
                continue
            if found is None:
                found = np.flatnonzero(scores)
            found = found[scores[found] + rest[at] >= floor]
            if not len(found):
                return
            place = np.searchsorted(docs, found).clip(max=len(docs) - 1)
            hit = docs[place] == found
            scores[found[hit]] += impacts[place[hit]]
        if found is None:
            found = np.flatnonzero(scores)
        found = found[scores[found] >= floor]
        if len(found):
            best.add(scores[found], self.ids[base + found], self.nameless[base + found])


def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Columns of `counted` rows, in parts of bounded size."""

    def joined(held):
        ids, nameless, sizes, counts, numbers, tfs = (np.concatenate(c) for c in zip(*held, strict=True))
        return ids, nameless, sizes, np.concatenate([[0], np.cumsum(counts)]), numbers, tfs

    held, rows, postings = [], 0, 0
    for batch in batches:
        ids, sizes, numbers, tfs = (batch.column(i) for i in range(4))
        ends = np.asarray(numbers.offsets)
        held.append((
            np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(sizes), np.diff(ends),
            np.asarray(numbers.values)[ends[0] : ends[-1]], np.asarray(tfs.values)[ends[0] : ends[-1]],
        ))
        rows, postings = rows + len(ids), postings + int(ends[-1] - ends[0])
        if rows >= DOCUMENTS or postings >= POSTINGS:
            yield joined(held)
            held, rows, postings = [], 0, 0
    if rows:
        yield joined(held)


# --- the operator -----------------------------------------------------------------


def _blocks(items: DataFrame, id_column: str, text_column: str) -> Iterator[list[tuple[int, list[bytes]]]]:
    """The items with a term in blocks of about BLOCK_TERMS terms, by a hash."""
    rows = items.select(
        items[id_column].cast("long").alias("item_id"), items[text_column].cast("string").alias("text")
    ).where("text is not null")
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-chars // (4 * BLOCK_TERMS))  # terms and what divides them are seldom shorter on average
    for block in range(count):
        mine = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        found = [(r.item_id, sorted(set(words(r.text)))) for r in mine.collect()]
        found = [x for x in found if x[1]]
        if found:
            yield found


def _search_block(
    docs: DataFrame, block: list[tuple[int, list[bytes]]], top: int, index: int
) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, found in block for t in found}))}
    forward = stored(counted(docs, vocabulary), "search-terms")
    documents, length = forward.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    holding = forward.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = np.zeros(len(vocabulary), np.int64)
    for term, count in holding:
        weights[term] = weight(documents, count)
    queries = [[vocabulary[t] for t in found if weights[vocabulary[t]]] for _, found in block]
    ids = [item_id for item_id, _ in block]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in queries]
        for columns in parts(batches):
            part = Part(*columns, weights, documents, length)
            for query, kept in zip(queries, best, strict=True):
                part.search(query, kept)
        for at, kept in enumerate(best):
            if len(kept.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at] * len(kept.scores), pa.int32()), pa.array([ids[at]] * len(kept.scores), pa.int64()),
                     pa.array(kept.ids, pa.int64(), mask=kept.nameless), pa.array(kept.scores, pa.int64())],
                    ["item", "item_id", "doc_id", "score"],
                )

    bounded_batches(spark)
    found = forward.mapInArrow(run, "item int, item_id long, doc_id long, score long")
    return found.select(F.lit(index).alias("block"), "*")


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: each item's `top` best rows of `docs`, from rank 1.

    Equal scores go by doc_id, null last. Rows that repeat an id or a text are
    documents of their own, and so are items; null texts, and texts without a term,
    are no documents, count nowhere, and as items find nothing. An empty table of
    either kind gives no row. Other columns are not read.
    """
    docs = texts(docs, id_column, text_column)
    found = None
    for index, block in enumerate(_blocks(items, item_column, item_text_column)):
        made = _search_block(docs, block, top, index)
        found = made if found is None else found.unionAll(made)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


_TERMS = (
    "regexp_extract_all(translate(text, '{upper}', '{lower}'),"
    " '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
).format(upper=ASCII_UPPER, lower=ASCII_LOWER)

OP13_SQL = f"""
WITH terms AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM counts GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes),
norms AS (SELECT doc_id, 100 - {LENGTH_SHARE} + ({LENGTH_SHARE} * n * docs) // length AS m FROM sizes, totals),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         CAST(sum(w * (({SCALE} * tf) // ({TF_SCALE} * tf + {LENGTH_SCALE} * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN norms USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM scored WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {TOP}
"""
