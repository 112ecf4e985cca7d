"""Language of a text, by unigram pieces with all segmentations summed.

Each language has a probability for every piece of a fixed public vocabulary. A
word's likelihood is the sum over all ways to cut it into pieces, which the
forward algorithm gives; pieces do not cross words, so a text's likelihood is the
product of its words'. The probabilities come from expectation maximisation over
the word counts of a bounded sample of labelled rows: a round spreads each word's
count over its segmentations, and only sums per language and piece, bounded by
the vocabulary, leave the tasks.

Words of equal length are the rows of one matrix, and all of them take a step of
the forward algorithm together; a worker remembers words it has scored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import batches_of, bounded_batches, read_table, rows_of, stored, texts

# Labelled rows that the model is fitted on at most, the first by a hash, and
# rounds of fitting.
SAMPLE_ROWS = 20_000
ROUNDS = 2
UNDETERMINED = "und"
# Score below which a filter rejects a text: no language is likelier than all others together.
LEAST_SCORE = 0.5
# Longest piece in characters; probability of a character outside the vocabulary.
LONGEST_PIECE = 12
UNKNOWN = 1e-8
SMOOTHING = 0.1
# Words a worker remembers, twice as many at most, some 250 bytes each, and rows of one matrix.
WORDS_KEPT = 200_000
WORDS_TOGETHER = 8_000
# Letters of a run that are fitted as one word.
LONGEST_TRAINED = 100

LETTERS = re.compile(r"[^\W\d_]+")
WORD_START = "▁"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Vocabulary:
    """Pieces by a hash of their characters, looked up for many strings at once."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = sorted(
            {
                piece.lower()
                for i in range(model.get_piece_size())
                if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
                and 0 < len(piece := model.id_to_piece(i)) <= LONGEST_PIECE
            }
        )
        hashes = np.array([self._hash(piece) for piece in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.size = hashes[order], len(pieces)
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces of the vocabulary have one hash")

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for char in piece:
            h = ((h + ord(char)) * int(_MULTIPLIER) ^ (h >> 29)) & (2**64 - 1)
        return h

    def pieces_by_end(self, words: np.ndarray) -> Iterator[list[tuple[int, np.ndarray]]]:
        """For every end 1..n the pieces of all words (rows of code points) that
        end there, as (characters, ids); id `size` is a character the vocabulary
        lacks, `size + 1` no piece. Each start's hash grows along with the ends,
        so that words of any length need room for the longest piece only."""
        count, n = words.shape
        hashes: list[np.ndarray] = []
        for end in range(n):
            hashes = [*hashes[-LONGEST_PIECE + 1 :], np.zeros(count, np.uint64)]
            hashes = [(h + words[:, end]) * _MULTIPLIER ^ (h >> np.uint64(29)) for h in hashes]
            found = []
            for length, h in enumerate(reversed(hashes), 1):
                place = np.searchsorted(self.hashes, h).clip(max=self.size - 1)
                ids = np.where(self.hashes[place] == h, place, self.size if length == 1 else self.size + 1)
                if length == 1 or (ids < self.size).any():
                    found.append((length, ids))
            yield found


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary_of(path: str) -> Vocabulary:
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def by_length(words: list[str]) -> Iterator[tuple[list[int], np.ndarray]]:
    """Positions and code points of words of equal length, each word with the
    mark of a word's start."""
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        groups.setdefault(len(word), []).append(i)
    for members in groups.values():
        for at in range(0, len(members), WORDS_TOGETHER):
            part = members[at : at + WORDS_TOGETHER]
            marked = "".join([WORD_START + words[i] for i in part])
            points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            yield part, points.reshape(len(part), -1)


def likelihoods(words: list[str], vocabulary: Vocabulary, table: np.ndarray) -> np.ndarray:
    """Log likelihood of every word in every language, by the forward algorithm:
    the sum up to an end is that over all pieces that end there, each times the
    sum up to its start. `table` is pieces x languages, its last row zero."""
    out = np.zeros((len(words), table.shape[1]))
    for members, points in by_length(words):
        recent = [np.ones((len(members), table.shape[1]))]
        log_scale = np.zeros_like(recent[0])
        for end, pieces in enumerate(vocabulary.pieces_by_end(points), 1):
            total = np.zeros_like(recent[0])
            for length, ids in pieces:
                total += recent[-length] * table[ids]
            recent = [*recent[-LONGEST_PIECE + 1 :], total]
            if end % 8 == 0:  # all sums a piece can still reach back to share a scale
                log_scale += np.log(total)
                recent = [r / total for r in recent]
        out[members] = np.log(recent[-1]) + log_scale
    return out


def expected_counts(
    words: list[str], counts: np.ndarray, vocabulary: Vocabulary, probability: np.ndarray
) -> np.ndarray:
    """How often each piece is expected in `words`, over all their segmentations
    under one language's probabilities: forward and backward sums, in logarithms."""
    out = np.zeros(vocabulary.size + 2)
    with np.errstate(divide="ignore"):
        log_p = np.log(probability)
    for members, points in by_length(words):
        lattice = list(vocabulary.pieces_by_end(points))
        ahead = [np.zeros(len(members))]
        for end, pieces in enumerate(lattice, 1):
            ways = [ahead[end - length] + log_p[ids] for length, ids in pieces]
            ahead.append(np.logaddexp.reduce(ways, axis=0))
        behind = [np.full(len(members), -np.inf) for _ in lattice] + [np.zeros(len(members))]
        for end in range(len(lattice), 0, -1):
            for length, ids in lattice[end - 1]:
                way = behind[end] + log_p[ids]
                share = np.exp(ahead[end - length] + way - ahead[-1]) * counts[members]
                out += np.bincount(ids, weights=share, minlength=len(out))
                behind[end - length] = np.logaddexp(behind[end - length], way)
    return out


def held_out(doc_id: Column) -> Column:
    """Rows nothing is learned from: crc32 of the id's text leaves 2 modulo 4, or there is no id."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(True))


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; very long ones in parts, as training needs
    a word's whole lattice at once."""
    runs = LETTERS.findall(text.lower())
    if all(len(run) <= LONGEST_TRAINED for run in runs):
        return runs
    return [run[at : at + LONGEST_TRAINED] for run in runs for at in range(0, len(run), LONGEST_TRAINED)]


def has_letter(text: str) -> bool:
    """Whether any character is a letter: the word pattern takes number signs, such
    as one half or a Roman numeral, as well."""
    return any(char.isalpha() for run in LETTERS.finditer(text) for char in run[0])


class Model:
    """Languages and their pieces' probabilities: `table`, pieces x languages;
    the row before the last is for unknown characters, the last is zero."""

    def __init__(self, languages: list[str], table: np.ndarray, path: str):
        self.languages, self.table, self.path = languages, table, path
        self.key = hashlib.sha256(repr((languages, path)).encode() + table.tobytes()).hexdigest()


def fit(
    docs: DataFrame, vocabulary_path: str, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS,
    id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
) -> Model:
    """Learn from text and non-null lang of rows that are not held out.

    At most `sample_rows` of them, those with the least hash of the three, so
    that the sample is the same for any partitioning and repeated rows count once. Without any labelled row the
    model has no language.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    labelled = docs.select(
        docs[id_column].cast("long").alias("doc_id"),
        F.coalesce(docs[text_column].cast("string"), F.lit("")).alias("text"),
        docs[lang_column].cast("string").alias("lang"),
    ).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    order = F.xxhash64("doc_id", "text", "lang")
    # Hashes of the sample alone pass through one task, which the bound allows. Rows
    # that are equal in all three have one hash and count once.
    last = labelled.select(order.alias("h")).distinct().orderBy("h").limit(sample_rows).agg(F.max("h")).first()[0]
    if last is None:
        return Model([], np.zeros((0, 0)), vocabulary_path)

    def count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: dict[str, Counter] = {}
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                counted.setdefault(lang, Counter()).update(words_of(text))
            rows = [(lang, word, n) for lang, words in counted.items() for word, n in words.items()]
            if rows:
                lang, word, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lang, pa.string()), pa.array(word, pa.string()), pa.array(n, pa.int64())],
                    ["lang", "word", "n"],
                )

    words = stored(
        labelled.withColumn("h", order)
        .where(F.col("h") <= last)
        .dropDuplicates(["h"])
        .select("text", "lang")
        .mapInArrow(count_words, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "lang-words",
    )
    languages = sorted(row["lang"] for row in words.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((0, 0)), vocabulary_path)
    size = vocabulary_of(vocabulary_path).size
    table = np.full((size + 2, len(languages)), 1.0 / size)
    table[size], table[size + 1] = UNKNOWN, 0.0
    number = {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds):
        now = spark.sparkContext.broadcast(table)  # vocabulary x languages

        def expect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vocabulary = vocabulary_of(vocabulary_path)
            sums = np.zeros((size + 2, len(languages)))
            for batch in batches:
                lang = np.array([number[x] for x in batch.column("lang").to_pylist()])
                words, n = batch.column("word").to_pylist(), np.array(batch.column("n").to_pylist(), float)
                for i in np.unique(lang):
                    mine = np.flatnonzero(lang == i)
                    sums[:, i] += expected_counts([words[k] for k in mine], n[mine], vocabulary, now.value[:, i])
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(sums[piece, lang])],
                ["piece", "lang", "n"],
            )

        with batches_of(spark, WORDS_TOGETHER):
            summed = (
                words.mapInArrow(expect, "piece long, lang long, n double")
                .groupBy("piece", "lang")
                .agg(F.sum("n").alias("n"))
                .toArrow()
            )
        counts = np.zeros((size + 2, len(languages)))
        counts[summed["piece"].to_numpy(), summed["lang"].to_numpy()] = summed["n"].to_numpy()
        counts = counts[:size] + SMOOTHING
        table = np.vstack(
            [counts / counts.sum(axis=0), np.full((1, len(languages)), UNKNOWN), np.zeros((1, len(languages)))]
        )
        now.unpersist()
    # Sums of doubles depend on their order in the last digits, which go here.
    return Model(languages, np.float64(np.float32(table)), vocabulary_path)


class Scorer:
    """Scores texts in one worker, remembering words by their lower-case form."""

    def __init__(self, model: Model):
        self.model, self.vocabulary = model, vocabulary_of(model.path)
        self.number: dict[str, int] = {}
        self.scores = np.zeros((1 << 12, len(model.languages)))
        self.older = (self.number, self.scores)

    def forget(self) -> None:
        """What has not been asked for since the memory was last full goes when
        it is full again."""
        self.older = (self.number, self.scores)
        self.number, self.scores = {}, np.zeros_like(self.scores)

    def learn(self, words: set[str]) -> None:
        """`words` as white space divides them; each may hold several runs of letters, or none."""
        new = [w for w in words if w not in self.number]
        if not new:
            return
        if len(self.number) + len(new) > WORDS_KEPT:
            self.forget()
            new = list(words)
        number, scores = self.older
        seen = [w for w in new if w in number]
        unseen = [w for w in new if w not in number]
        self._add(seen, scores[[number[w] for w in seen]])
        runs = [LETTERS.findall(w) for w in unseen]
        flat = [run for found in runs for run in found]
        values = likelihoods(flat, self.vocabulary, self.model.table)
        sums = np.zeros((len(unseen), self.scores.shape[1]))
        np.add.at(sums, np.repeat(np.arange(len(unseen)), [len(found) for found in runs]), values)
        self._add(unseen, sums)

    def _add(self, words: list[str], scores: np.ndarray) -> None:
        first, last = len(self.number), len(self.number) + len(words)
        while last > len(self.scores):
            self.scores = np.vstack([self.scores, np.zeros_like(self.scores)])
        self.scores[first:last] = scores
        self.number.update(zip(words, range(first, last), strict=True))

    def predict(self, batch: list[str]) -> tuple[list[str], list[float]]:
        if not self.model.languages:
            return [UNDETERMINED] * len(batch), [0.0] * len(batch)
        cut = [text.lower().split() for text in batch]
        self.learn({w for words in cut for w in words})
        labels, scores = [], []
        for text, words in zip(batch, cut, strict=True):
            if not has_letter(text):
                labels.append(UNDETERMINED)
                scores.append(0.0)
                continue
            total = self.scores[[self.number[w] for w in words]].sum(axis=0)
            best = int(total.argmax())
            labels.append(self.model.languages[best])
            scores.append(float(1.0 / np.exp(total - total[best]).sum()))
        return labels, scores


_SCORERS: dict[str, Scorer] = {}


def scorer_of(model: Model) -> Scorer:
    """The worker's scorer for this model, which it keeps from task to task."""
    if model.key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.key] = Scorer(model)
    return _SCORERS[model.key]


def predict(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row of `docs`, from its text alone.

    score is the posterior of the language, all being equally likely before; a
    text that is null, empty or without a letter, or a model without languages,
    gives `und` and 0. Ties go to the first language by name. Every row is
    judged by itself, whatever its id; an empty table gives no row; other
    columns are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # vocabulary x languages

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for ids, batch in rows_of(batches):
            labels, scores = scorer.predict(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    found = texts(docs, id_column, text_column).mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs` whose text has a language with a score of `least` at least.

    Null and empty texts, and those without a letter, have none and go; with a model
    without languages all rows go. Rows are judged one by one, repeated ones alike;
    an empty table stays one, and all columns stay.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # vocabulary x languages

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(shared.value)
        for batch in batches:
            if batch.num_rows:
                labels, scores = scorer.predict([text or "" for text in batch.column("text").to_pylist()])
                kept = [a != UNDETERMINED and b >= least for a, b in zip(labels, scores, strict=True)]
                yield batch.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents")
    return predict(docs, fit(docs, public_tokenizers.path("piece_bpe_32k.model")))
