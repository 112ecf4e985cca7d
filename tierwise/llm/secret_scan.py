"""Secrets in texts: fixed patterns, and two character Markov models.

The patterns give the base spans and label the training data as well: what they
match is a sample of random strings, every other long token one of ordinary
identifiers. For both kinds the pairs of neighbouring characters are counted
over all documents, in tables of fixed size that each task adds up before the
shuffle. A token no pattern knows is a secret if the random model explains it
better by a log-likelihood ratio above the threshold.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import bounded_batches, read_table, rows_of, texts

# The base patterns and the least lengths of what they match.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "random")

# Characters of the models; index 0 stands for a token's edge.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
STATES = len(ALPHABET) + 1
STATE_OF = np.zeros(256, np.int64)
STATE_OF[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, STATES)

# Tokens that train the ordinary model and are judged; no base pattern takes shorter ones.
LONG_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{12,}")
# Nats by which the random model must win: odds of about 3 million to one.
THRESHOLD = 15.0

_KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns as (kind, start, end), leftmost and without
    overlap within a kind; in code points."""
    spans = []
    lowered = text.encode("utf-8", "replace").lower()
    if any(word in lowered for word in _KEYWORDS):  # the costly pattern only where it can match
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    # A maximal run of 16 or more; shorter runs are no match either way.
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


def other_tokens(text: str, spans: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Long tokens that touch none of the spans."""
    # Spans that overlap as one, so that the first to end after a token's start decides.
    taken: list[tuple[int, int]] = []
    for start, end in sorted((start, end) for _, start, end in spans):
        if taken and start < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(end, taken[-1][1]))
        else:
            taken.append((start, end))
    at = 0
    for m in LONG_TOKEN.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            yield m.span()


def pair_counts(tokens: Iterable[str]) -> np.ndarray:
    """STATES x STATES counts of neighbouring characters, edges included."""
    joined = np.frombuffer(("\n" + "\n".join(tokens) + "\n").encode("ascii", "replace"), np.uint8)
    states = STATE_OF[joined]
    return np.bincount(states[:-1] * STATES + states[1:], minlength=STATES * STATES)


def train(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> np.ndarray | None:
    """Log ratios random : ordinary for every pair of characters, learned from
    all documents; None if either kind of token does not occur at all."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, STATES * STATES), np.int64)
        for _, batch in rows_of(batches):
            random, ordinary = [], []
            for text in batch:
                spans = base_spans(text)
                for kind, start, end in spans:
                    if kind != "assign":
                        random.append(text[start:end])
                    else:
                        value = ASSIGN.match(text, start)[2]
                        random += LONG_TOKEN.findall(value)
                ordinary += [text[a:b] for a, b in other_tokens(text, spans)]
            counts[0] += pair_counts(random) if random else 0
            counts[1] += pair_counts(ordinary) if ordinary else 0
        label, pair = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(label, pa.int64()), pa.array(pair, pa.int64()), pa.array(counts[label, pair], pa.int64())],
            ["label", "pair", "n"],
        )

    summed = (
        texts(docs, id_column, text_column)
        .mapInArrow(run, "label long, pair long, n long")
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
    )
    counts = np.zeros((2, STATES * STATES))
    for row in summed.collect():  # 2 x STATES x STATES rows at most
        counts[row["label"], row["pair"]] = row["n"]
    if not counts.any(axis=1).all():
        return None
    smoothed = counts.reshape(2, STATES, STATES) + 1.0
    log_p = np.log(smoothed / smoothed.sum(axis=2, keepdims=True))
    return log_p[0] - log_p[1]


def likelihood_ratio(token: str, ratios: np.ndarray) -> float:
    states = STATE_OF[np.frombuffer(f"\n{token}\n".encode("ascii"), np.uint8)]
    return float(ratios[states[:-1], states[1:]].sum())


def all_spans(text: str, ratios: np.ndarray | None, threshold: float = THRESHOLD) -> list[tuple[str, int, int]]:
    """Base spans and those the models add, by start and then by kind."""
    spans = base_spans(text)
    if ratios is not None:
        spans += [
            ("random", start, end)
            for start, end in other_tokens(text, spans)
            if likelihood_ratio(text[start:end], ratios) >= threshold
        ]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(
    docs: DataFrame, ratios: np.ndarray | None, threshold: float = THRESHOLD,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """doc_id and spans (array of kind, start, end in code points) per row of `docs`.

    A null or empty text has no span. Rows are judged one by one, whatever their
    id; an empty table gives no row; other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, batch in rows_of(batches):
            found = [
                [{"kind": k, "start": a, "end": b} for k, a, b in all_spans(text, ratios, threshold)] for text in batch
            ]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, span)], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"
    return texts(docs, id_column, text_column).mapInArrow(run, schema)


def redact(docs: DataFrame, ratios: np.ndarray | None, placeholder: str = "[SECRET]") -> DataFrame:
    """The rows of `docs` with every span (overlapping ones as one) replaced in
    `text`, and `n_chars`, if there is one, counted anew where a text changed.

    Every row and every other column stays as it is; null and empty texts too. Rows
    that repeat an id or a text are redacted each by itself; an empty table stays one.
    """
    bounded_batches(docs.sparkSession)
    schema = docs.schema

    def clean(text: str | None) -> str | None:
        spans = all_spans(text, ratios) if text else []
        if not spans:
            return text
        parts, at = [], 0
        for _, start, end in spans:
            if start >= at:
                parts += [text[at:start], placeholder]
            at = max(at, end)
        return "".join(parts) + text[at:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            before = batch.column("text").to_pylist()
            after = [clean(text) for text in before]
            columns = list(batch.columns)
            columns[names.index("text")] = pa.array(after, batch.schema.field("text").type)
            if "n_chars" in names:
                counted = batch.column("n_chars").to_pylist()
                counted = [len(a) if a != b else n for a, b, n in zip(after, before, counted, strict=True)]
                columns[names.index("n_chars")] = pa.array(counted, batch.schema.field("n_chars").type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    spans = F.col("spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != "random")
    return find_secrets(docs, train(docs)).select(
        "doc_id", count("assign"), count("access"), count("hex"), count("random"),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"),
    )
