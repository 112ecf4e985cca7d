"""Documents packed into fixed windows of token ids, best fit decreasing.

Every document is tokenised and cut into as many full windows as it fills; a
full window is a sequence by itself. The rests of all documents of an input
partition are placed in decreasing length, each into the tightest window that
still takes it, found by a segment tree over remaining capacity. Everything
happens where the text is read: nothing is shuffled, and a task holds one Arrow
batch of texts and one small record per rest. With the few thousand documents
of an input partition, padding is well below one per cent.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import hashing
from tierwise.llm.common import bounded_batches, read_table, rows_of, texts

WINDOW = 2048
END_ID = 1
# Rests that are packed together at most; an input partition rarely has more.
RESTS_TOGETHER = 1 << 18
# Words whose ids a worker remembers, twice as many at most, some 200 bytes each.
WORDS_KEPT = 700_000

PIECES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ]
)


class Vocabulary:
    """Ids of whole texts, put together from the ids of their words.

    The tokenizer drops white space, and neither its normaliser nor its pattern
    reaches across it, so that a text has the ids of its ASCII-separated words
    in a row. It lower-cases as well, so A-Z may be lowered first, except where
    that could spell one of its special tokens.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        """The ids of every text, as little-endian unsigned 32-bit numbers."""
        raw = [text.encode("utf-8", "replace") for text in batch]
        odd = [i for i, r in enumerate(raw) if b"<|" in r]
        lowered = [b"" if b"<|" in r else r.lower() for r in raw]
        out = self._of_lowered(lowered)
        for i in odd:
            words = [w if b"<|" in w else w.lower() for w in raw[i].split()]
            self._learn(set(words))
            out[i] = np.frombuffer(b"".join([self.known[w] for w in words]), "<u4")
        return out

    def _of_lowered(self, texts: list[bytes]) -> list[np.ndarray]:
        """Each different word of the texts is looked up once, found by its hash;
        a second hash makes sure of it."""
        joined = b"\n".join(texts)
        raw = np.frombuffer(joined, np.uint8)
        starts, lengths, sums = hashing.words(raw)
        if not len(starts):
            return [np.zeros(0, "<u4")] * len(texts)
        _, first, which = np.unique(hashing.mix(sums), return_index=True, return_inverse=True)
        second = hashing.words(raw[::-1])[2][::-1]
        if (second[first][which] != second).any():
            first, which = np.arange(len(starts)), np.arange(len(starts))
        words = [joined[a:b] for a, b in zip(starts[first].tolist(), (starts + lengths)[first].tolist(), strict=True)]
        self._learn(set(words))
        ids = [self.known[w] for w in words]
        count = np.array([len(x) // 4 for x in ids])
        flat = np.frombuffer(b"".join(ids), "<u4")
        begin = (np.cumsum(count) - count)[which]
        count = count[which]
        ends = np.cumsum(count)
        all_ids = flat[np.repeat(begin - (ends - count), count) + np.arange(ends[-1])]
        # Where each text's words end, and with them its ids.
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        words_before = np.searchsorted(starts, text_ends)
        return np.split(all_ids, np.concatenate([[0], ends])[words_before][:-1])

    def _learn(self, words: set[bytes]) -> None:
        """Make all of `words` known. What has not been asked for since the
        memory was last full is forgotten when it is full again."""
        if len(self.known) + len(words) > WORDS_KEPT:
            self.older, self.known = self.known, {}
        encode, known, older = self.tokenizer.encode, self.known, self.older

        def learn(word: bytes) -> bytes:
            ids = known.get(word) or older.get(word)
            if not ids:
                ids = encode(word.decode("utf-8"), add_special_tokens=False).ids
                ids = struct.pack(f"<{len(ids)}I", *ids)
            known[word] = ids
            return ids

        for w in words:
            if w in known:
                continue
            tail = w[-1:]
            # "word," is "word" and "," to the tokenizer's pattern.
            if tail in b".," and w[-2:-1].isalpha() and b"<|" not in w:
                known[w] = learn(w[:-1]) + learn(tail)
            else:
                learn(w)


class CapacityTree:
    """How many open windows have each remaining capacity, as a segment tree:
    the smallest capacity that takes a length is found in log steps."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        node = capacity + self.size
        while node:
            self.count[node] += 1
            node >>= 1

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """A window with the least capacity of at least `length`, taken out."""
        count, node = self.count, length + self.size
        if not count[node]:
            # Up to the first right-hand neighbour that has any, then down its left edge.
            while node > 1 and not (node % 2 == 0 and count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node *= 2
                if not count[node]:
                    node += 1
        capacity = node - self.size
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of every length (each 1 to `window`)."""
    order = np.argsort(-lengths, kind="stable")
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    tree, opened = CapacityTree(window), 0
    for i, length in zip(order.tolist(), lengths[order].tolist(), strict=True):
        found = tree.take_tightest(length)
        if found is None:
            capacity, target = window, opened
            opened += 1
        else:
            capacity, target = found
        where[i], offset[i] = target, window - capacity
        if capacity > length:
            tree.add(capacity - length, target)
    return where, offset


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text has the end id only. Rows that repeat a doc_id are
    documents of their own, also with a null doc_id. sequence_id holds the
    input partition in its upper half, so it is unique but has gaps. An empty
    table gives no piece; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(tokenizer_path)
        base, used = TaskContext.get().partitionId() << 32, 0
        rests: list[tuple] = []

        def place() -> pa.RecordBatch:
            nonlocal used, rests
            lengths = np.array([r[2] for r in rests], np.int64)
            where, offset = best_fit_decreasing(lengths, window)
            columns = [list(c) for c in zip(*rests, strict=True)]
            sequence = (base + used + where).tolist()
            used += int(where.max()) + 1
            rests = []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (*columns, sequence, offset.tolist())], schema=PIECES
            )

        for ids, batch in rows_of(batches):
            full: list[tuple] = []
            for doc_id, found in zip(ids, vocabulary.encode(batch), strict=True):
                packed = np.append(found, end)
                tokens = len(packed)
                whole = tokens - tokens % window
                for start in range(0, whole, window):
                    crc = zlib.crc32(packed[start : start + window])
                    full.append((doc_id, start, window, crc, tokens, base + used, 0))
                    used += 1
                if whole < tokens:
                    rests.append((doc_id, whole, tokens - whole, zlib.crc32(packed[whole:]), tokens))
            if full:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*full, strict=True)], schema=PIECES
                )
            if len(rests) >= RESTS_TOGETHER:
                yield place()
        if rests:
            yield place()

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return texts(docs, id_column, text_column).mapInArrow(run, schema)


_VOCABULARIES: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    """One per worker process, so that words stay known from task to task."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
