"""SentencePiece BPE by the last token of every prefix, and decoding.

In greedy merging a row of tokens is the encoding of its text exactly if every two
neighbours are the encoding of theirs: up to the first merge that would cross the
border of two tokens, both go on as they do alone. So the encoding of a prefix is
the encoding of a shorter prefix and one token that may follow its last one, and
there is only one such token. An automaton lists the pieces that end at each place,
the test of two neighbours picks the one that fits, and a table keeps it; the tokens
of the whole are then read off backwards. A text of any length takes a time in
proportion to it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm.common import bounded_batches, read_table, rows_of, texts

SPACE = "▁"
# What a worker remembers at most: words (some 300 bytes each), pairs of neighbours
# (some 150), histories of pieces. Longer words than this are encoded each time.
WORDS_KEPT, PAIRS_KEPT = 500_000, 1_000_000
LONGEST_KEPT = 64
# As the public library shows an id that stands for no text.
UNKNOWN_SURFACE = " ⁇ "
# Types of pieces and kind of model in the public format.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


class PieceCoder:
    """Encodes and decodes by one model file of kind BPE.

    Accepts models whose normaliser only marks spaces and puts one in front; any
    other (character maps, white space removed, pieces defined by the user) is a ValueError.
    """

    def __init__(self, path: str):
        import codecs

        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        codecs.register_error("tierwise.each-byte", _one_by_one)
        with open(path, "rb") as raw:
            model = sentencepiece_model_pb2.ModelProto.FromString(raw.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != BPE or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("not a model of byte-pair merges with spaces in front")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("the model's normaliser does more than mark spaces")
        if any(p.type not in (NORMAL, UNKNOWN, CONTROL, BYTE) for p in model.pieces):
            raise ValueError("the model has pieces that its user defined")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.names = [p.piece for p in model.pieces]
        self.types = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.unknown = self.types.index(UNKNOWN)
        by_byte = {int(p.piece[3:-1], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.bytes = [by_byte[b] for b in range(256)] if model.trainer_spec.byte_fallback else None
        self.byte_values = {i: b for b, i in by_byte.items()}
        # Whether an encoding's first token can only be a piece that begins with the space put in front.
        self.marks_front = bool(self.prefix) and SPACE in self.ids
        # The first merge is that of the highest score, of equals the leftmost.
        self.cost = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ids:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.cut = self._cut()
        self.known: dict[str, tuple[str, int, str]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.histories: dict[str, tuple[bool, list[tuple[float, str, str]]]] = {}

    def _cut(self):
        """A function that cuts a text where no merge can cross, by what the pieces
        hold: before a space's mark that follows anything else, and between an
        ASCII letter and another ASCII character. Parts recur more often than wholes."""
        inside = [(a, b) for piece in self.ids for a, b in zip(piece, piece[1:])]
        if any(b == SPACE != a for a, b in inside):
            return lambda text: [text] if text else []
        if any(a.isascii() and a.isalpha() and b.isascii() and not b.isalpha() for a, b in inside):
            return re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        other = f"[^{SPACE}A-Za-z]*+"
        return re.compile(rf"(?!\Z){SPACE}*+{other}(?:[A-Za-z]++(?:[^\x00-\x7F{SPACE}]{other})?)*+").findall

    # --- which tokens may be neighbours ------------------------------------

    def history(self, piece: str) -> tuple[bool, list[tuple[float, str, str]]]:
        """Whether merging `piece` alone ends in one token, and its merges in
        their order: cost, first and last symbol after it."""
        found = self.histories.get(piece)
        if found is None:
            parts, merges = list(piece), []
            while len(parts) > 1:
                costs = [self.cost.get(a + b, inf) for a, b in zip(parts, parts[1:])]
                least = min(costs)
                if least == inf:
                    break
                at = costs.index(least)
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
                merges.append((least, parts[0], parts[-1]))
            found = self.histories[piece] = (len(parts) == 1, merges)
        return found

    def neighbours(self, left: str, right: str) -> bool:
        """Whether merging both together ends in these two tokens: their own
        merges interleave by cost, and none across the border comes before them."""
        whole, before = self.history(left)
        also, after = self.history(right)
        if not (whole and also):
            return False
        i = j = 0
        last, first = left[-1], right[0]
        while True:
            mine = before[i][0] if i < len(before) else inf
            other = after[j][0] if j < len(after) else inf
            across = self.cost.get(last + first, inf)
            if across < mine and across <= other:
                return False
            if mine == other == inf:
                return True
            if mine <= other:
                last, i = before[i][2], i + 1
            else:
                first, j = after[j][1], j + 1

    # --- encoding ------------------------------------------------------------

    def tokens(self, text: str) -> list[str]:
        """Tokens of `text`, in which spaces are marked already."""
        pairs, last, filled = self.pairs, [""] * (len(text) + 1), 0
        for end, piece in self.automaton.iter(text):
            end += 1
            while filled < end - 1:  # all pieces that end there have been tried
                filled += 1
                if not last[filled]:
                    last[filled] = text[filled - 1]  # a character without a piece
            if last[end]:
                continue
            start = end - len(piece)
            if start:
                pair = (last[start], piece)
                fits = pairs.get(pair)
                if fits is None:
                    fits = pairs[pair] = self.neighbours(*pair)
            else:
                fits = self.history(piece)[0]
            if fits:
                last[end] = piece
        out, end = [], len(text)
        for at in range(filled + 1, end + 1):
            last[at] = last[at] or text[at - 1]
        while end:
            out.append(last[end])
            end -= len(last[end])
        if len(pairs) > PAIRS_KEPT:
            self.pairs = {}
        if len(self.histories) > WORDS_KEPT:
            self.histories = {}
        return out[::-1]

    def ids_of(self, marked: str) -> list[int]:
        out = []
        for token in self.tokens(marked):
            found = self.ids.get(token)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out += [self.bytes[b] for b in token.encode("utf-8", "replace")]
            else:
                out.append(self.unknown)
        return out

    def marked(self, text: str) -> str:
        return self.prefix + text.replace(" ", SPACE) if text else ""

    def encode(self, text: str) -> list[int]:
        return [i for word in self.cut(self.marked(text)) for i in self.ids_of(word)]

    def word(self, word: str) -> tuple[str, int, str]:
        """Ids joined by commas, their number, and the text they give."""
        ids = self.ids_of(word)
        found = (",".join(map(str, ids)), len(ids), self.surface(ids))
        if len(word) <= LONGEST_KEPT:
            if len(self.known) > WORDS_KEPT:
                self.known = {}
            self.known[word] = found
        return found

    # --- decoding ------------------------------------------------------------

    def surface(self, ids: Iterable[int]) -> str:
        """Text of ids with every space that is marked."""
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            value = self.byte_values.get(i)
            if value is not None:
                pending.append(value)
                continue
            if pending:
                out.append(pending.decode("utf-8", "tierwise.each-byte"))
                pending = bytearray()
            if self.types[i] == UNKNOWN:
                out.append(UNKNOWN_SURFACE)
            elif self.types[i] == NORMAL:
                out.append(self.names[i].replace(SPACE, " "))
        out.append(pending.decode("utf-8", "tierwise.each-byte"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of the ids. The space put in front goes, if the first text is a
        piece that begins with one; a space as a byte stays."""
        first = next((i for i in ids if self.types[i] != CONTROL), None)
        surface = self.surface(ids)
        if self.prefix and first is not None and self.types[first] == NORMAL and surface.startswith(" "):
            return surface[1:]
        return surface


_CODERS: dict[str, PieceCoder] = {}


def coder_of(path: str) -> PieceCoder:
    """One per worker process, so that words stay known from task to task."""
    if path not in _CODERS:
        _CODERS[path] = PieceCoder(path)
    return _CODERS[path]


def encode_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, ids (array of int), decoded (the text that the ids give), per row.

    A null or empty text has no ids. Every row is encoded by itself, whatever its
    id, null or repeated; an empty table gives no row; other columns are not read.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for ids, batch in rows_of(batches):
            for doc_id, text in zip(ids, batch, strict=True):
                coded = coder.encode(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([coded], pa.list_(pa.int32())),
                     pa.array([coder.decode(coded)])], ["doc_id", "ids", "decoded"],
                )

    return texts(docs, id_column, text_column).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digest_documents(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 per row of `docs`; as
    encode_documents, but only counts and digests leave the worker."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for ids, batch in rows_of(batches):
            counts, coded, decoded = [], [], []
            for text in batch:
                known = coder.known.get
                words = [known(word) or coder.word(word) for word in coder.cut(coder.marked(text))]
                counts.append(sum([w[1] for w in words]))
                coded.append(hashlib.sha256(",".join([w[0] for w in words]).encode()).hexdigest())
                surface = "".join([w[2] for w in words])
                front = coder.marks_front and surface.startswith(" ")
                decoded.append(hashlib.sha256(surface[front:].encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(coded), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return texts(docs, id_column, text_column).mapInArrow(run, schema)


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest_documents(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")
    )
