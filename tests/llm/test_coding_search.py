"""Pieces by the public library, fill-in-the-middle and ranked search by brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from tests.llm.rows import edge_docs, empty_docs, prose, texts
from tierwise.llm import lexical, middle, pieces

SMALL = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def strange(seed: int, count: int, names: list[str]) -> list[str]:
    rng = random.Random(seed)
    any_char = lambda: chr(rng.choice([rng.randint(0, 0x2FF), rng.randint(0, 0xD7FF), rng.randint(0xE000, 0x10FFFF)]))
    kinds = [
        lambda: "".join(rng.choices("abcde \n\t▁éßЖ日本🙂\x00\u0085<0x>sunk/,.", k=rng.randint(0, 30))),
        lambda: "".join(rng.choices(names, k=rng.randint(1, 6))),
        lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 40))),
        lambda: "".join(any_char() for _ in range(rng.randint(1, 10))),
    ]
    return [kinds[i % 4]() for i in range(count)]


# --- pieces ------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_as_the_library(library):
    coder = pieces.PieceCoder(MODEL)
    for text in strange(1, 6000, coder.names):
        ids = library.encode(text)
        assert coder.encode(text) == ids, repr(text)
        assert coder.decode(ids) == library.decode(ids), repr(text)
    rng = random.Random(2)
    for _ in range(2000):  # ids that no text gives: bytes, unknown and control ids in any order
        ids = [rng.choice([rng.randint(0, 31_999), rng.randint(0, 262)]) for _ in range(rng.randint(0, 8))]
        assert coder.decode(ids) == library.decode(ids), ids


def test_pieces_of_long_texts(library):
    coder = pieces.PieceCoder(MODEL)
    for text in ("ab" * 100_000, " " * 100_000, "x" * 50_000 + "\n" * 50_000, "日" * 50_000, prose(1, 40_000)):
        assert coder.encode(text) == library.encode(text)
    assert len(coder.encode("w" * 1_000_000)) > 1  # in a time that grows with the text


def test_pieces_without_memory(library, monkeypatch):
    """Forgetting words, pairs and histories changes nothing."""
    monkeypatch.setattr(pieces, "WORDS_KEPT", 3)
    monkeypatch.setattr(pieces, "PAIRS_KEPT", 2)
    coder = pieces.PieceCoder(MODEL)
    for text in strange(3, 200, coder.names):
        words = [coder.known.get(w) or coder.word(w) for w in coder.cut(coder.marked(text))]
        assert ",".join(w[0] for w in words) == ",".join(map(str, library.encode(text)))
        assert len(coder.known) <= 4 and len(coder.pairs) <= 100


def test_merges_that_come_late():
    """Of two readings of a text the one that merges cheaper pairs first holds."""
    coder = pieces.PieceCoder(MODEL)
    assert coder.neighbours(*coder.tokens("▁the"[:2] + "q")) is True
    assert coder.tokens("▁t" "he") == ["▁the"] and not coder.neighbours("▁t", "he")
    assert not coder.neighbours("h", "e")


def test_pieces_query(spark, library):
    def expected(rows):
        return Counter(
            (i, len(ids := library.encode(t or "")), sha(",".join(map(str, ids))), sha(library.decode(ids))) for i, t in rows
        )

    rows = [*texts(), (50, "\x00 nul"), (51, "a" * 200_000), (52, "\n" * 100_000)]
    docs = edge_docs(spark).select("doc_id", "text").unionAll(spark.createDataFrame(rows[-3:], "doc_id long, text string"))
    assert Counter(map(tuple, pieces.digest_documents(docs, MODEL).collect())) == expected(rows)
    assert pieces.digest_documents(empty_docs(spark), MODEL).count() == 0
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, pieces.op11_pieces(spark, SMALL).collect())) == expected(small)
    coded = {r.doc_id: r for r in pieces.encode_documents(edge_docs(spark), MODEL).collect()}
    assert coded[9].ids == library.encode(dict(texts())[9]) and coded[9].decoded == dict(texts())[9]
    assert coded[5].ids == [] and coded[5].decoded == ""


def test_pieces_need_a_plain_model(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    with open(MODEL, "rb") as raw:
        model = sentencepiece_model_pb2.ModelProto.FromString(raw.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.PieceCoder(str(tmp_path / "other.model"))


# --- fill in the middle ---------------------------------------------------------


def plain_middle(doc_id, text) -> tuple:
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, sha(text), sha(text)
    p, m, s = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    form = "spm" if h4 % 100 < 20 else "psm"
    output = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), form, len(p), len(m), sha(output), sha(text)


def test_middle(spark, monkeypatch):
    rows = [
        *texts(), (60, "a <P> b"), (61, "<S>"), (62, "x<M"), (63, "<<P><"), (64, "<S<P"), (65, "w" * 400_000 + " " * 9),
        (66, "\n" * 150_000), (67, "a1" * 70_000), (68, "\x00 é🙂" * 9), (69, ("w" * 3000 + " ") * 40), (70, prose(3, 50_000)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    made = middle.transform(docs)
    found = made.selectExpr("*", "sha2(output, 256) AS digest").withColumn("text", middle.restored(made.output, made.form))
    found = [
        (r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.digest, sha(r.text)) for r in found.collect()
    ]
    assert Counter(found) == Counter(plain_middle(*r) for r in rows)
    assert middle.transform(edge_docs(spark)).count() == len(texts())
    assert middle.transform(empty_docs(spark)).count() == 0
    small = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter(plain_middle(*r) for r in small)
    assert Counter(map(tuple, middle.op12_middle(spark, SMALL).collect())) == expected
    assert {"psm", "spm", "plain"} == {key[2] for key in expected}


def test_rank_index():
    rng = np.random.default_rng(4)
    cases = [
        np.array([0]), np.array([0, 7]), np.arange(50_000), np.cumsum(rng.integers(1, 9, 60_000)),
        np.cumsum(np.where(rng.random(30_000) < 0.001, 1_000_000, 1)), np.cumsum(rng.zipf(1.5, 20_000).clip(max=10**6)),
        np.cumsum(np.where(np.arange(9000) == 4000, 10**9, 1)),
    ]
    for offsets in cases:
        index = middle.RankIndex(offsets.astype(np.int64))
        assert index.residuals.dtype == np.int8
        assert (index.select(np.arange(len(offsets))) == offsets).all()
    regular = middle.RankIndex(np.arange(0, 10**6, 5))
    assert regular.segments.shape[1] == -(-200_000 // middle.SEGMENT) and not regular.residuals.any()


def test_texts_go_together_up_to_a_size(monkeypatch):
    monkeypatch.setattr(middle, "CHARS_TOGETHER", 10)
    batch = ["", "abc", "x" * 30, "de", "fgh", "ijklm", "n"]
    runs = list(middle.together(list(range(7)), batch))
    assert [t for _, run in runs for t in run] == batch and [i for ids, _ in runs for i in ids] == list(range(7))
    assert max(sum(map(len, run)) for _, run in runs if len(run) > 1) <= 10


# --- ranked search -------------------------------------------------------------------


def plain_search(docs, items, top: int = 50) -> list[tuple]:
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = [(i, Counter(pattern.findall((t or "").translate(lower)))) for i, t in docs]
    counts = [c for c in counts if c[1]]
    N, L = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in counts:
            m = 50 + 50 * c.total() * N // L
            asked = set(pattern.findall((text or "").translate(lower))) & c.keys()
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in asked
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, nameless, doc_id) in enumerate(sorted(scored)[:top], 1):
            out.append((item_id, rank, None if nameless else doc_id, -score))
    return out


ITEMS = [
    (1, prose(1, 60)), (2, None), (3, ""), (4, "... !"), (5, "two WORDS words"), (5, "two WORDS words"), (None, prose(2, 20)),
    (6, "É ß 日本語 nothingelse"), (7, "Licence licensed the of all"), (8, prose(11, 400)), (9, "absent alone"), (10, "x 345"),
]


def test_search(spark):
    docs = [*texts(), (71, prose(1, 40_000)), (72, "x " * 50_000), (73, "\n" * 99_999)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame = frame.selectExpr("*", "'clash' AS n", "1 AS term", "2 AS score", "3 AS rank", "4 AS item_id").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id", "2 AS block", "3 AS item")
    assert Counter(map(tuple, lexical.search(frame, items).collect())) == Counter(plain_search(docs, ITEMS))
    assert Counter(map(tuple, lexical.search(frame, items, top=2).collect())) == Counter(plain_search(docs, ITEMS, 2))
    assert lexical.search(edge_docs(spark), items.limit(0)).count() == 0
    assert lexical.search(empty_docs(spark), items).count() == 0


def test_search_in_blocks_of_items(spark, monkeypatch):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    monkeypatch.setattr(lexical, "BLOCK_TERMS", 100)
    assert len(list(lexical._blocks(items, "item_id", "text"))) > 3
    assert Counter(map(tuple, lexical.search(docs, items).collect())) == Counter(plain_search(texts(), ITEMS))


def test_search_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    assert Counter(map(tuple, lexical.op13_search(spark, SMALL).collect())) == Counter(plain_search(docs, items))


@pytest.mark.parametrize("short", [1, 8, 10**9])
def test_parts_windows_and_short_lists(monkeypatch, short):
    """All lists short, some, none; small windows and parts: always the best documents."""
    monkeypatch.setattr(lexical, "WINDOW", 16)
    monkeypatch.setattr(lexical, "SHORT", short)
    monkeypatch.setattr(lexical, "DOCUMENTS", 70)
    rng = np.random.default_rng(short)
    count, vocabulary, rows = 400, 40, []
    for i in range(count):
        found = np.flatnonzero(rng.random(vocabulary) < np.linspace(0.005, 0.9, vocabulary))
        tfs = rng.zipf(1.8, len(found)).clip(max=500)
        rows.append((int(rng.integers(0, 300)), int(tfs.sum() + 1 + rng.integers(0, 50)), found.tolist(), tfs.tolist()))
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])
    table = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
    weights = rng.integers(0, 6000, vocabulary)
    length = sum(r[1] for r in rows)
    queries = [np.flatnonzero(rng.random(vocabulary) < share).tolist() for share in (0.05, 0.3, 0.9) for _ in range(8)]
    best = [lexical.Best(10) for _ in queries]
    made = list(lexical.parts(table.to_batches(max_chunksize=23)))
    assert len(made) > 3
    for columns in made:
        part = lexical.Part(*columns, weights, count, length)
        for query, kept in zip(queries, best):
            part.search([t for t in query if weights[t]], kept)
    for query, kept in zip(queries, best):
        scored = []
        for doc_id, n, found, tfs in rows:
            m = 50 + 50 * n * count // length
            score = sum(int(weights[t]) * (10**9 * tf // (1000 * tf + 20 * m)) for t, tf in zip(found, tfs) if t in query)
            if score:
                scored.append((-score, doc_id))
        assert [(-s, i) for s, i in zip(kept.scores.tolist(), kept.ids.tolist())] == sorted(scored)[:10]
