"""From raw documents to packed sequences, as five stages over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tierwise.llm import exact, jaccard, langid, packing, secret_scan
from tierwise.llm.common import read_table, stored

# Near duplicates of the pipeline: words in a shingle, and per cent of similarity.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go; the model learns from `docs`.

    Null and empty texts, and those without a letter, go. Without any labelled row
    there is no language, and all go; repeated rows share their fate.
    """
    model = langid.fit(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return langid.keep_identified(docs, model)


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays.

    Null and empty texts are equal. Rows that repeat doc_id and text are one and stay
    together, as do rows without a doc_id where no equal row has one.
    """
    return exact.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near copies connect, the one with the smallest doc_id stays.

    Texts without a word are near to nothing, and stay, as do rows without a doc_id;
    rows that repeat one share its fate.
    """
    return jaccard.drop_similar(docs, NEAR_WORDS, NEAR_PERCENT)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text become a placeholder.

    Null and empty texts stay as they are. Where the corpus has no token of one of
    both kinds there are no models, and only the patterns' matches go.
    """
    return secret_scan.redact(docs, secret_scan.train(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most 2048 tokens.

    A null or empty text is a piece of its end alone; repeated rows are packed each.
    Which sequence a piece is in depends on the partitions of `docs`, which are those
    of stored files here.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact),
    ("n-gram Jaccard join", drop_near),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

# Language ID, the Markov models and tokenisation are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each reads what the one before has written. No document
    gives no row; columns that documents has besides its own stay until packing."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
