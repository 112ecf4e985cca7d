"""Byte-level BPE with numpy: encoding by rank files, and decoding.

A text is cut by the vocabulary's pattern, and the different pieces of a batch
that are not yet known are encoded together: pieces of similar length are the
rows of one padded matrix of token ids. In every round each row merges its
leftmost pair of least rank, which a hash table of id pairs gives; rows close
the gap, and rows without any mergeable pair leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm.common import bounded_batches, read_table, rows_of, texts

NONE = np.int64(1) << 40
# Different pieces a worker remembers, some 300 bytes each.
PIECES_KEPT = 500_000
# Cells of one padded matrix at most, to bound a round's temporaries.
CELLS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class PairTable:
    """(left id, right id) -> id of the merged token, by open addressing.

    As in the rank-file convention a pair may merge if the joined bytes are a
    token, whichever pair that token was first made of.
    """

    def __init__(self, ranks: dict[bytes, int]):
        pairs = [
            (ranks[token[:cut]] << 20 | ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        keys = np.array([k for k, _ in pairs], np.int64)
        values = np.array([v for _, v in pairs], np.int64)
        slots, left = self._slot(keys), np.arange(len(keys))
        while len(left):  # one key wins each free slot; the others move on by one
            free = self.keys[slots[left]] == -1
            chosen, first = np.unique(slots[left[free]], return_index=True)
            won = left[free][first]
            self.keys[chosen], self.values[chosen] = keys[won], values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, NONE where it is no token or an id is missing (-1)."""
        out = np.full(left.shape, NONE, np.int64)
        known = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[known] << 20 | right.ravel()[known]
        slots = self._slot(keys)
        flat = out.ravel()
        while len(known):
            found = self.keys[slots]
            hit = found == keys
            flat[known[hit]] = self.values[slots[hit]]
            on = ~hit & (found != -1)
            known, keys, slots = known[on], keys[on], (slots[on] + 1) & (len(self.keys) - 1)
        return flat.reshape(left.shape)


class ByteBpe:
    """Encodes and decodes by one rank file; pieces are cut by `pattern`.

    A lone surrogate, which no UTF-8 column can hold, counts as U+FFFD.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        # White space is the Unicode property, without the separators U+001C to
        # U+001F that Python counts as well.
        space = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.cut = regex.compile(space).findall
        self.ranks = ranks
        self.pairs = PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.known: dict[str, tuple[str, bytes]] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece, by padded matrices of pieces of similar length."""
        out: list[list[int]] = [[]] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[i] = [rank]
            elif piece:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for bits, members in buckets.items():
            step = max(1, CELLS >> bits)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self._merge([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        inside = np.arange(width) < lengths[:, None]
        ids = np.full((len(pieces), width), -1, np.int64)
        ids[inside] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        rows = np.arange(len(pieces))
        out: list[list[int]] = [[]] * len(pieces)
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while True:
            best = ranks.argmin(axis=1)  # the leftmost of equals
            least = ranks[np.arange(len(rows)), best]
            done = least == NONE
            if done.any():
                for row, line in zip(rows[done].tolist(), ids[done], strict=True):
                    out[row] = line[line >= 0].tolist()
                on = ~done
                rows, ids, ranks, best, least = rows[on], ids[on], ranks[on], best[on], least[on]
                if not len(rows):
                    return out
            # Close the gap behind the merged id; ranks move along, and only the
            # two pairs that the new id is part of are looked up again.
            columns = np.arange(ids.shape[1] - 1)
            ids = np.where(columns <= best[:, None], ids[:, :-1], ids[:, 1:])
            line = np.arange(len(rows))
            ids[line, best] = least
            if ids.shape[1] == 1:
                ranks = np.full((len(rows), 1), NONE, np.int64)
                continue
            ranks = np.where(columns[:-1] <= best[:, None], ranks[:, :-1], ranks[:, 1:])
            right = best < ids.shape[1] - 1
            at = best[right]
            ranks[line[right], at] = self.pairs.ranks(ids[line[right], at], ids[line[right], at + 1])
            left = best > 0
            at = best[left]
            ranks[line[left], at - 1] = self.pairs.ranks(ids[line[left], at - 1], ids[line[left], at])
            # Columns that are padding in every row go.
            used = int((ids >= 0).sum(axis=1).max())
            if used < ids.shape[1]:
                ids = ids[:, :used]
                ranks = ranks[:, : max(1, used - 1)]

    def learn(self, pieces: Iterable[str]) -> None:
        new = [p for p in set(pieces) if p not in self.known]
        raw = [p.encode("utf-8", "replace") for p in new]
        for piece, ids in zip(new, self.encode_pieces(raw), strict=True):
            self.known[piece] = (" ".join(map(str, ids)), self.decode(ids))

    def forget_if_full(self) -> None:
        if len(self.known) > PIECES_KEPT:
            self.known = {}

    def encode(self, text: str) -> list[int]:
        pieces = self.cut(text)
        self.learn(pieces)
        return [int(i) for p in pieces for i in self.known[p][0].split()]

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


_BPES: dict[tuple[str, str], ByteBpe] = {}


def bpe_of(path: str, pattern: str) -> ByteBpe:
    """One per worker process, so that pieces stay known from task to task."""
    if (path, pattern) not in _BPES:
        _BPES[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return _BPES[path, pattern]


def encode_documents(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, ids (array of int), decoded (the bytes that the ids give), per row.

    A null or empty text has no ids. Every row is encoded by itself, whatever
    its id; an empty table gives no row; other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(path, pattern)
        for ids, batch in rows_of(batches):
            for doc_id, text in zip(ids, batch, strict=True):
                coded = bpe.encode(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([coded], pa.list_(pa.int32())),
                     pa.array([bpe.decode(coded)], pa.binary())], ["doc_id", "ids", "decoded"],
                )
                bpe.forget_if_full()

    return texts(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digest_documents(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of `docs`; as
    encode_documents, but only counts and digests leave the worker."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(path, pattern)
        for ids, batch in rows_of(batches):
            counts, coded, decoded = [], [], []
            cut = [bpe.cut(text) for text in batch]
            bpe.learn(p for pieces in cut for p in pieces)
            for pieces in cut:
                parts = [bpe.known[p] for p in pieces]
                line = " ".join([p[0] for p in parts])
                counts.append(line.count(" ") + 1 if line else 0)
                coded.append(hashlib.sha256(line.encode()).hexdigest())
                decoded.append(hashlib.sha256(b"".join([p[1] for p in parts])).hexdigest())
            bpe.forget_if_full()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts(docs, id_column, text_column).mapInArrow(run, schema)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return digest_documents(
        read_table(spark, sf_dir, "documents"), public.path("byte_bpe_50k.tiktoken"), public.PATTERN
    )
