"""Operators that compare documents: against DuckDB and brute force."""

from __future__ import annotations

from collections import defaultdict
from math import floor

import numpy as np
import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tests.llm.rows import edge_docs, empty_docs, plain, prose, texts
from tierwise.llm import exact, jaccard, line_runs, registry, topk, units
from tierwise.llm.components import components

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_query_against_sql(spark, con, name):
    assert differences(registry.queries()[name](spark, SMALL), con, registry.oracle_sql()[name]) == []


def counted(rows) -> dict:
    out = defaultdict(int)
    for r in rows:
        out[tuple(r)] += 1
    return dict(out)


def by_words(pairs) -> dict:
    """Rows of equal text: here, equal after collapsing white space."""
    import re

    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    return groups


def test_exact(spark):
    want = []
    for ids in by_words(texts()).values():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep) for i in ids]
    got = exact.exact_duplicates(edge_docs(spark)).drop("text_sha256").collect()
    assert counted(got) == counted(want)
    assert exact.exact_duplicates(empty_docs(spark)).count() == 0


def test_exact_drop_keeps_columns_and_rows(spark):
    docs = edge_docs(spark)
    kept = exact.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    want = []
    for ids in by_words(texts()).values():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i,) for i in ids if i == keep]
    assert counted(kept.select("doc_id").collect()) == counted(want)
    assert exact.drop_exact_duplicates(empty_docs(spark)).count() == 0


def shingle_set(text: str | None, words: int) -> frozenset:
    w = plain(text)
    if len(w) < words:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1))


def similar_by_hand(pairs, words: int, percent: int) -> list[tuple]:
    sets = [shingle_set(t, words) for _, t in pairs]
    root = list(range(len(pairs)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least: dict = {}
    for r, (doc_id, _) in zip(root, pairs, strict=True):
        if doc_id is not None:
            least[r] = min(doc_id, least.get(r, doc_id))
    return [
        (doc_id, len(s), least.get(r) if s else doc_id) for r, (doc_id, _), s in zip(root, pairs, sets, strict=True)
    ]


@pytest.mark.parametrize("words, percent", [(3, 90), (5, 80), (2, 60)])
def test_jaccard_components(spark, words, percent):
    rng = np.random.default_rng(words)
    pairs = texts()
    base = prose(21, 150).split()
    for i in range(60):  # a group whose members are at all distances from each other
        changed = list(base)
        for at in rng.integers(0, len(base), rng.integers(0, 9)):
            changed[at] = f"w{rng.integers(0, 40)}"
        pairs.append((100 + i, " ".join(changed)))
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    got = jaccard.jaccard_components(docs, words, percent).collect()
    assert counted(got) == counted(similar_by_hand(pairs, words, percent))


def test_jaccard_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_SHINGLES", 900)
    test_jaccard_components(spark, 3, 90)


def test_jaccard_sketches_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_WORDS", 12)
    test_jaccard_components(spark, 5, 80)


def test_jaccard_sends_no_sets_of_dissimilar_documents(spark, monkeypatch):
    shared = prose(31, 900).split()
    pairs = [(i, " ".join([f"x{i}y{k}" for k in range(400)] + shared)) for i in range(40)]
    pairs.append((40, pairs[7][1] + " more"))
    sent = []
    full_sets = jaccard._full_sets
    monkeypatch.setattr(jaccard, "_full_sets", lambda docs, wanted, words: sent.append(wanted.count()) or full_sets(docs, wanted, words))
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(4)
    got = jaccard.jaccard_components(docs, 5, 80).collect()
    assert counted(got) == counted(similar_by_hand(pairs, 5, 80))
    assert sent == [2]


def test_jaccard_edges(spark):
    assert jaccard.jaccard_components(empty_docs(spark)).count() == 0
    docs = edge_docs(spark)
    kept = jaccard.drop_similar(docs, 5, 80)
    assert kept.columns == docs.columns
    with pytest.raises(ValueError):
        jaccard.jaccard_components(docs, 3, 0)


def test_jaccard_on_all_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = jaccard.op7_ngram_join(spark, SMALL).collect()
    assert counted(got) == counted(similar_by_hand(docs, 3, 90))


def test_divide_skip_finds_every_similar_set():
    rng = np.random.default_rng(2)
    base = rng.choice(10_000, 200, replace=False).astype(np.uint64)
    sets = []
    for _ in range(80):
        changed = base.copy()
        at = rng.integers(0, 200, rng.integers(0, 30))
        changed[at] = rng.integers(20_000, 20_200, len(at)).astype(np.uint64)
        sets.append(np.unique(changed))
    block = jaccard.Block(sets, 90)
    for i, a in enumerate(sets):
        want = [j for j, b in enumerate(sets) if j != i and 10 * len(np.intersect1d(a, b)) >= 9 * len(np.union1d(a, b))]
        assert sorted(block.similar(i, np.ones(len(sets), bool))) == want


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_sketches_connect_every_similar_pair(percent):
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    sets = []
    for size in rng.integers(1, 300, 120):  # of four widths
        extra = rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)
        sets.append(np.unique(np.append(base[:size], extra)))
    sketches, sizes = [jaccard.sketch(s) for s in sets], [len(s) for s in sets]
    assert {len(s) for s in sketches} >= {1, 2, 4}
    for sides in ([0] * 120, [k % 2 for k in range(120)]):
        root = list(range(120))
        for a, b in jaccard.near_in(list(range(120)), sizes, sketches, sides, percent):
            old, new = root[b], root[a]
            root = [new if r == old else r for r in root]
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b), percent):
                    assert root[i] == root[j] or sides[i] == sides[j] and len(set(sides)) > 1


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    parts = jaccard.Parts(percent)
    for _ in range(600):
        base = np.unique(rng.integers(0, 2**63, rng.integers(1, 80)).astype(np.uint64) * np.uint64(2))
        other = base[rng.random(len(base)) < 1 - rng.random() / 3]
        other = np.unique(np.append(other, rng.integers(0, 2**63, rng.integers(0, 6)).astype(np.uint64)))
        common = len(np.intersect1d(base, other))
        if jaccard.linked(common, len(base), len(other), percent) and common < max(len(base), len(other)):
            shared = [
                (np.intersect1d(a, b).size, x, y)
                for a, x in parts.signatures(base)
                for b, y in parts.signatures(other)
                if np.intersect1d(a, b).size
            ]
            assert any(n >= max(x, y) for n, x, y in shared)


@pytest.mark.parametrize("shape", ["chain", "star", "two", "none"])
def test_components(spark, shape):
    edges = {
        "chain": [(i, i + 1) for i in range(40)], "star": [(7, i) for i in range(20)] + [(3, 3)],
        "two": [(1, 2), (2, 1), (5, 4), (4, 6)], "none": [],
    }[shape]
    root: dict = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).distinct().collect()
    want = {k: v for k, v in root.items() if any(a != b and k in (a, b) for a, b in edges)}
    assert dict(map(tuple, got)) == want and len(got) == len(want)


def units_by_hand(pairs, unit_end: str, min_words: int) -> set[tuple]:
    """(doc_id, unit, start, end, keep_doc_id, keep_start) of what goes."""
    import re

    found = []
    for nameless, doc_id, text in sorted({(i is None, i or 0, t or "") for i, t in pairs}):
        start = unit = 0
        for end in [*(m.end() for m in re.finditer(unit_end, text)), len(text)]:
            if words := plain(text[start:end]):
                found.append(((nameless, doc_id, text), unit, start, end, words))
                unit += 1
            start = end
    first: dict = {}
    # The hash of the text, which ranks texts of one id, is Spark's; these cases do not need it.
    for key, unit, start, end, words in sorted(found, key=lambda u: (u[0][:2], u[2])):
        first.setdefault(b" ".join(words), (key, start))
    out, stretch = set(), []

    def close():
        if sum(len(u[4]) for u in stretch if len(u[4]) >= units.COUNTED_FROM) >= min_words:
            for key, unit, start, end, words in stretch:
                keep, keep_start = first[b" ".join(words)]
                out.add((None if key[0] else key[1], unit, start, end, None if keep[0] else keep[1], keep_start))
        stretch.clear()

    for u in found:
        if stretch and (stretch[-1][0] != u[0] or stretch[-1][1] + 1 != u[1]):
            close()
        if first[b" ".join(u[4])] != (u[0], u[2]):
            stretch.append(u)
    close()
    return out


def passages() -> list[tuple[int, str]]:
    """Passages in short lines, within lines, over blank lines; lone short lines."""
    short = "\n".join(prose(s, 6) for s in range(40, 44))
    inside = ". ".join(prose(s, 9) for s in range(50, 54))
    hello = "hello and welcome"
    return [
        (1, f"{hello}\n{short}\n{prose(60, 30)}"), (2, f"{hello}\n{prose(61, 30)}\n{short}"), (3, short.replace("\n", "\n \n\n")),
        (4, f"{prose(62, 12)}. {inside}. {prose(63, 12)}"), (5, f"{prose(64, 5)}! {inside}. end"), (6, f"{hello}\n{prose(65, 40)}"),
        (7, f"{prose(40, 6)}\n{prose(66, 9)}\n{prose(41, 6)}"), (8, "\n".join([prose(67, 10)] * 20)), (9, "\n".join([prose(68, 12)] * 5000)),
        (10, "\n".join([prose(68, 12)] * 5000)), (11, "\n" * 100_000), (13, "AH!! " * 90), (12, " ".join([prose(69, 60)] * 2)),
    ]


@pytest.mark.parametrize("unit_end", ["LINE", "SENTENCE", "PARAGRAPH"])
def test_units(spark, unit_end):
    rows = texts() + [(i + 100, t) for i, t in passages()]
    docs = edge_docs(spark).select("doc_id", "text").unionAll(spark.createDataFrame(rows[len(texts()):], "doc_id long, text string"))
    end = getattr(units, unit_end)
    got = units.repeated_units(docs, unit_end=end)
    got = got.select("doc_id", "unit", "start", "end", "keep_doc_id", "keep_start").distinct().collect()
    assert {tuple(r) for r in got} == units_by_hand(rows, end, units.MIN_WORDS)
    assert units.repeated_units(empty_docs(spark)).count() == 0


def test_passages_go_and_lone_lines_stay(spark):
    docs = spark.createDataFrame(passages(), "doc_id long, text string")
    cut = {r.doc_id: r for r in units.drop_repeated_units(docs).collect()}
    text = dict(passages())
    assert [i for i, r in sorted(cut.items()) if r.removed_spans is None] == [1, 4, 6, 7, 11, 12, 13]
    assert all(cut[i].text == text[i] for i in (1, 4, 6, 7, 11, 12, 13))
    assert cut[2].text == "".join(text[2].splitlines(True)[:2]) and not cut[3].text.strip()
    assert cut[5].text == f"{prose(64, 5)}! end"
    assert cut[8].text == prose(67, 10) + "\n" and cut[9].text == prose(68, 12) + "\n"
    # The last line has no line break after it, which is no difference.
    assert cut[10].text == ""


def test_units_are_cut_out(spark):
    docs = edge_docs(spark)
    cut = units.drop_repeated_units(docs, min_words=10)
    by_id = {r.doc_id: r for r in cut.where("doc_id IN (5, 9, 10, 17)").collect()}
    assert cut.count() == len(texts()) and cut.columns == [*docs.columns, "removed_spans"]
    assert by_id[5].text is None and by_id[5].removed_spans is None
    first = texts()[11][1]
    shared = first.split("\n")[1]
    assert by_id[9].text == first
    assert by_id[10].text == "" and [tuple(s) for s in by_id[10].removed_spans] == [
        (0, len(shared) + 1), (len(shared) + 1, 2 * len(shared) + 1)
    ]
    assert by_id[17].text == ""


def runs_by_hand(pairs, least: int) -> dict[int | None, set]:
    """Lines that go, by doc_id: windows of `least` lines that occur earlier."""
    seen, gone = set(), defaultdict(set)
    for nameless, doc_id, text in sorted({(i is None, i or 0, t) for i, t in pairs if t}):
        lines = [b" ".join(plain(line)) for line in text.split("\n")]
        for at in range(len(lines) - least + 1):
            window = tuple(lines[at : at + least])
            if all(window):
                if window in seen:
                    gone[None if nameless else doc_id] |= set(range(at, at + least))
                seen.add(window)
    return dict(gone)


@pytest.mark.parametrize("least", [1, 2, 3])
def test_line_runs(spark, least):
    pairs = [(i, t) for i, t in texts() if i is not None]
    line = [prose(s, 4) for s in range(30, 36)]
    order = [(0, 1, 2, 3), (4, 0, 1, 2, 3), (1, 2, 1, 2, 1, 2), (5, 3, 4, 0, 1), (2, 2, 2, 2, 2), (0, 1, 2, 3)]
    pairs += [(200 + n, "\n".join(line[k] for k in ks)) for n, ks in enumerate(order)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    got = defaultdict(set)
    for r in line_runs.repeated_runs(docs, least).collect():
        got[r.doc_id] |= set(range(r.start_line, r.start_line + r.n_lines))
        assert r.matched_lines >= least
    assert dict(got) == runs_by_hand(pairs, least)


def test_line_runs_over_blank_lines(spark):
    line = [prose(s, 4) for s in range(40, 46)]
    order = [(0, 1, 2, 3), (4, 0, 1, 2, 3), (1, 2, 1, 2), (5, 3, 4, 0, 1), (0, 1, 2, 3)]
    close = [(n, "\n".join(line[k] for k in ks)) for n, ks in enumerate(order)]
    apart = [(i, "\n" + text.replace("\n", "\n \t\n\n") + "\n") for i, text in close]

    def gone(pairs, step):
        rows = line_runs.repeated_runs(spark.createDataFrame(pairs, "doc_id long, text string"), 2).collect()
        return {
            (r.doc_id, (r.start_line - (step > 1)) / step, (r.n_lines - 1) / step, r.first_doc_id,
             (r.first_line - (step > 1)) / step, r.matched_lines)
            for r in rows
        }

    assert gone(close, 1) and gone(apart, 3) == gone(close, 1)
    kept = line_runs.drop_repeated_runs(spark.createDataFrame(apart, "doc_id long, text string"), 2)
    assert {r.doc_id: r.text.split() for r in kept.collect()}[4] == []


def test_line_runs_over_blank_lines_as_sql(spark, tmp_path):
    """The statement lets blank lines pass, as the operator does."""
    import duckdb

    body = [prose(s, 5) for s in range(80, 86)]
    docs = [
        (1, "\n".join(body)), (2, "\n\n \n".join(body)), (3, "\n" + "\n\n".join(body[2:5]) + "\n\nother\n" + body[0]),
        (4, "\n".join([*body[4:], "", body[0], "", "", body[1], "end"])), (5, None), (6, " \n\n"), (7, "\n\n".join([body[1]] * 5)),
    ]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    theirs = con.execute(line_runs.OP10_SQL).fetchall()
    ours = [tuple(r) for r in line_runs.op10_line_runs(spark, str(tmp_path)).collect()]
    assert sorted(ours) == sorted(theirs) and len(ours) == 4


def test_line_runs_edges(spark):
    docs = edge_docs(spark)
    kept = line_runs.drop_repeated_runs(docs)
    assert kept.columns == docs.columns and kept.count() == len(texts())
    by_id = {r.doc_id: r.text for r in kept.collect()}
    before = dict(texts())
    assert by_id[15] == before[15] and by_id[17] == "" and by_id[5] is None
    assert by_id[16] == before[16].split("\n")[0]
    assert line_runs.repeated_runs(empty_docs(spark)).count() == 0


def top_by_hand(rows, is_query, k: int) -> set:
    whole = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    ints = [(i, [floor(1024 * float(np.float32(x))) for x in v]) for i, v in whole]
    out = set()
    for q in sorted({i for i, _ in ints if is_query(i)}):
        vector = min(v for i, v in ints if i == q)
        scored = sorted((-sum(a * b for a, b in zip(vector, v)), i) for i, v in ints if i != q)
        out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROWS_IN_BLOCK", 64)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # ties
    rows += [(400, None), (500, [1.0, None]), (501, [float("nan")] * 8), (502, [float("inf")] * 8), (None, [1.0] * 8),
             (600, []), (700, [0.5, 0.25]), (800, [900.0] * 8), (801, [-900.0] * 8)]
    vectors = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows],
                                    "vec_id long, embedding array<float>, rank string, cells string")
    for k in (3, 10, 1000):
        got = topk.top_k(vectors, vectors["vec_id"] % 100 == 0, k).collect()
        assert {tuple(r) for r in got} == top_by_hand(rows, lambda i: i % 100 == 0, k)
    assert topk.top_k(vectors.limit(0), vectors["vec_id"] % 100 == 0).count() == 0


def test_pipeline(spark):
    """Each stage on what the one before kept, against a plain version of its decision."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    named = stages["language ID"](spark, docs, SMALL)
    assert {r.doc_id for r in named.collect()} == set(rows)  # all of them are in a language
    once = stages["exact dedup"](spark, named, SMALL)
    kept = {min(ids) for ids in by_words((i, r.text) for i, r in rows.items()).values()}
    assert {r.doc_id for r in once.collect()} == kept and once.columns == docs.columns
    apart = stages["n-gram Jaccard join"](spark, once, SMALL)
    pairs = [(i, rows[i].text) for i in sorted(kept)]
    kept = {i for i, _, c in similar_by_hand(pairs, 5, 80) if i == c}
    assert {r.doc_id for r in apart.collect()} == kept and apart.columns == docs.columns
    clean = stages["secret scans"](spark, apart, SMALL)
    assert {r.doc_id for r in clean.collect()} == kept and clean.columns == docs.columns
    pieces = stages["packing"](spark, clean, SMALL).collect()
    assert {r.doc_id for r in pieces} == kept
    whole = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in whole.collect()} == kept
