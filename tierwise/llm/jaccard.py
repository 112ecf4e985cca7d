"""Documents whose word shingles overlap, by T-occurrence search.

A document is the set of the 64-bit hashes of its distinct shingles; equal sets
are one node. Sets of similar nodes differ in few shingles. So if the range of
hashes is cut into more parts than that, some part holds the same shingles in
both, and the digest of a part's shingles, its signature, is equal.

1. Inverted lists of signatures tell which nodes can have partners at all. Every
   list is led by its most connected node, and the lists of a leader make up a
   block: nodes that share a list meet in a block, and a node is in few.
2. There nodes meet as sketches, some bit per shingle: whether it falls to the bit
   an odd number of times. Each bit in which two sketches differ is a shingle or
   more that only one of the sets has, so sets whose sketches differ in too many
   are not similar. Nodes that the other pairs connect are a group; similar nodes
   are in one group, a node is in one at most, and most nodes are in none.
3. A group is searched by DivideSkip: every node asks for the nodes that occur at
   least T times in the group's inverted lists of its shingles, T being the
   overlap it needs. The short lists are heap-merged for candidates; those are
   looked up in the long lists by binary search, until they reach T or cannot.
   What links to the leader is connected, and is only compared with the rest.
4. Links give components. Blocks and groups of any size are split into pairs of
   chunks of bounded size, and only chunks pass through Python; texts are never
   shuffled, and sets only of nodes in a group.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm import hashing
from tierwise.llm.common import batches_of, bounded_batches, read_table, stored, texts
from tierwise.llm.components import components
from tierwise.llm.hashing import mix

SHINGLE_WORDS = 3
PERCENT = 90
# Equal parts that two similar sets have beyond one, apart from those that are
# empty in both and say nothing.
SPARE_PARTS = 4
# Bits of the filters that tell in later passes over the texts which signatures
# and which sets are asked for. Their size is fixed; more data only makes them
# less selective, never wrong.
FILTER_BITS = 25
# Shingles in one chunk of a group, and 64-bit words of sketches in one of a block.
CHUNK_SHINGLES = 1 << 17
CHUNK_WORDS = 1 << 19
# How much a step of the heap costs against one of a binary search, for the
# number of lists that count as long.
LONG_LIST_FACTOR = 0.0085


def shingles(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles: `words` words in a row, or all of
    them if there are fewer; A-Z lower-cased, words divided by ASCII white space."""
    word = mix(hashing.words(np.frombuffer(text.encode("utf-8", "replace").lower(), np.uint8))[2])
    if not len(word):
        return word
    count = min(words, len(word))
    h = np.full(len(word) - count + 1, count, np.uint64)
    for i in range(count):
        h = mix(h * hashing.GOLDEN + word[i : len(word) - count + 1 + i])
    return np.unique(h)


def set_digest(items: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set, as two signed numbers."""
    a = mix(items + np.uint64(0x632BE59BD9B4E019))
    b = mix(items * np.uint64(0xD6E8FEB86659FD93) + np.uint64(len(items)))
    return tuple(int(x.sum(dtype=np.uint64).astype(np.int64)) for x in (a, b))


def sketch(items: np.ndarray) -> np.ndarray:
    """Which bits an odd number of shingles falls to, in 64-bit words. There are as
    many bits as the first power of two that the set does not exceed, 64 at least;
    the two halves of a sketch combined by exclusive or are the one of half the bits."""
    bits = max(64, 1 << (len(items) - 1).bit_length())
    odd = np.bincount((items & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<u8")


def least_overlap(size: int, percent: int = PERCENT) -> int:
    """Shingles that a set shares with any set similar to it, at least."""
    return -(-percent * size // 100)


def linked(common: int, size: int, other: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (size + other - common)


class Block:
    """Inverted lists over the shingles of some sets, and DivideSkip on them."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.sets, self.percent = sets, percent
        self.sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.lexsort((owner, flat))
        flat, self.owner = flat[order], owner[order]
        self.items, self.begin = np.unique(flat, return_index=True)
        self.end = np.append(self.begin[1:], len(flat))

    def similar(self, query: int, wanted: np.ndarray) -> list[int]:
        """Members of the boolean mask `wanted` that are linked to member `query`."""
        size = int(self.sizes[query])
        least = least_overlap(size, self.percent)
        place = np.searchsorted(self.items, self.sets[query])
        lengths = self.end[place] - self.begin[place]
        place = place[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        n_long = min(least - 1, int(least / (LONG_LIST_FACTOR * np.log2(max(2, longest)) + 1)))
        short, long = place[: size - n_long], place[size - n_long :]
        lists = [self.owner[self.begin[p] : self.end[p]].tolist() for p in short]
        need = least - n_long
        found = [
            (member, seen)
            for member, group in groupby(heapq.merge(*lists))
            if wanted[member] and member != query and (seen := sum(1 for _ in group)) >= need
        ]
        if not found:
            return []
        members, seen = (np.array(x) for x in zip(*found, strict=True))
        # Overlap that each of them needs: 100 c >= percent (size + other - c).
        total = self.percent * (size + self.sizes[members])
        needs = -(-total // (100 + self.percent))
        for done, p in enumerate(long):
            listed = self.owner[self.begin[p] : self.end[p]]
            at = np.searchsorted(listed, members).clip(max=len(listed) - 1)
            seen = seen + (listed[at] == members)
            able = seen + (len(long) - done - 1) >= needs
            if not able.all():
                members, seen, needs = members[able], seen[able], needs[able]
                if not len(members):
                    return []
        return members[seen >= needs].tolist()


def links_in(ids: list[int], sets: list[np.ndarray], sides: list[int], leader: int, percent: int) -> list[tuple]:
    """Links among the nodes of one pair of chunks that connect what is linked.

    `sides` tells the chunk of each node, 0 or 1 (all 0 in a chunk against
    itself), or 2 for the leader if it is in neither. Nodes linked to the leader
    are connected by it, so only the others ask; those that are connected by now
    are not looked for again.
    """
    block = Block(sets, percent)
    root = list(range(len(ids)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []

    def connect(i: int, j: int) -> None:
        a, b = find(i), find(j)
        if a != b:
            root[max(a, b)] = min(a, b)
            links.append((ids[i], ids[j]))

    at = bisect_left(ids, leader)
    everything = np.ones(len(ids), bool)
    for i in block.similar(at, everything):
        connect(at, i)
    side = np.array(sides)
    alone = not (side == 1).any()
    for i in range(len(ids)):
        if find(i) == find(at):
            continue
        # Across the two chunks: pairs within one are for that chunk's own cell.
        across = everything if alone or side[i] == 2 else side != side[i]
        group = find(i)
        wanted = across & np.array([find(j) != group for j in range(len(ids))])
        for j in block.similar(i, wanted):
            connect(i, j)
    return links


def near_in(ids: list[int], sizes: list[int], sketches: list[np.ndarray], sides: list[int], percent: int) -> list[tuple]:
    """Pairs of nodes of one pair of chunks that connect all whose sketches let
    them be similar; `sides` as in `links_in`."""
    order = sorted(range(len(ids)), key=lambda k: (sizes[k], ids[k]))
    size, side = np.array(sizes)[order], np.array(sides)[order]
    alone = not (side == 1).any()
    # Sketches grow with the sets, so those of one width are in a row.
    width = np.array([len(sketches[k]) for k in order])
    begins = {int(w): int(np.searchsorted(width, w)) for w in np.unique(width)}
    ends = {w: int(np.searchsorted(width, w, "right")) for w in begins}
    made = {(w, w): np.stack([sketches[k] for k in order[begins[w] : ends[w]]]) for w in begins}

    def folded(w: int, to: int) -> np.ndarray:
        if (w, to) not in made:
            wider = folded(w, 2 * to)
            made[w, to] = wider[:, :to] ^ wider[:, to:]
        return made[w, to]

    group = np.arange(len(ids))
    pairs = []
    # A smaller set's share of a larger one is `percent` at least.
    upto = np.searchsorted(size * percent, size * 100, "right")
    for q in range(len(ids)):
        able = group[q + 1 : upto[q]] != group[q]
        if not alone:
            able &= side[q + 1 : upto[q]] != side[q]
        others = q + 1 + np.flatnonzero(able)
        for w in begins:
            some = others[(others >= begins[w]) & (others < ends[w])]
            some = some[group[some] != group[q]]
            if not len(some):
                continue
            own = int(width[q])
            differ = np.bitwise_count(folded(w, own)[some - begins[w]] ^ made[own, own][q - begins[own]]).sum(1, np.int64)
            both = size[q] + size[some]
            some = some[differ <= both - 2 * -(-percent * both // (100 + percent))]
            met, first = np.unique(group[some], return_index=True)
            pairs += [(ids[order[q]], ids[order[k]]) for k in some[first]]
            group[np.isin(group, met)] = group[q]
    return pairs


class Parts:
    """Cuts of the range of hashes, by the sizes of the sets.

    Sizes fall into intervals so wide that the partners of a set lie in its own
    or a neighbouring one. Interval i has a cut for the pairs whose larger set
    lies in it, so a set uses the cuts of its own and of the next interval.
    """

    def __init__(self, percent: int):
        self.percent = percent
        self.last = [0]  # largest size of every interval
        self.cuts: dict[int, tuple[np.ndarray, int]] = {}

    def interval(self, size: int) -> int:
        while self.last[-1] < size:
            least = self.last[-1] + 1
            self.last.append(max(least, 100 * least // self.percent))
        return bisect_left(self.last, size)

    def cut(self, interval: int) -> tuple[np.ndarray, int]:
        """Lower bounds of the parts, and how many parts there are beyond the
        shingles in which two similar sets can differ: some of them make up for
        parts that are expected to be empty."""
        if interval not in self.cuts:
            while len(self.last) <= interval:
                self.interval(self.last[-1] + 1)
            differ = 2 * self.last[interval] * (100 - self.percent) // (100 + self.percent)
            smallest = self.last[interval - 1] + 1
            parts = differ + 1 + SPARE_PARTS
            empty = parts * math.exp(-smallest / parts)
            spare = 1 + SPARE_PARTS + math.ceil(empty + 3 * math.sqrt(empty))
            parts = differ + spare
            self.cuts[interval] = np.array([k * 2**64 // parts for k in range(parts)], np.uint64), spare
        return self.cuts[interval]

    def signatures(self, items: np.ndarray) -> list[tuple[np.ndarray, int]]:
        """For both cuts of a set its signatures, as signed numbers, and how many
        of them it has at least in common with a similar set.

        Of all parts, `spare` at least are equal in two similar sets. Parts that
        are empty in both are no more than are empty in either, and the others
        are signatures they share. Empty parts have no signature, unless there
        are so many in a set that they could be all that is equal.
        """
        size = len(items)
        if not linked(size, size, size + 1, self.percent):
            return []  # nothing but an equal set can be similar
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(items), dtype=np.uint64)])
        own = self.interval(size)
        found = []
        for interval in (own, own + 1):
            cut, spare = self.cut(interval)
            at = np.append(np.searchsorted(items, cut), size)
            filled = at[1:] > at[:-1]
            common = spare - int(len(cut) - filled.sum())
            if common < 1:
                filled[:] = True
            part = np.arange(len(cut), dtype=np.uint64) + np.uint64(interval << 32)
            signatures = mix(sums[at[1:]] - sums[at[:-1]] + mix(part * hashing.GOLDEN + np.uint64(1)))[filled]
            found.append((signatures.view(np.int64), max(1, common)))
        return found


def _joined(found: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *found])


def _filter_of(values: DataFrame, column: str) -> np.ndarray:
    """A bit per upper bits of the values, set where there is any."""
    bit = F.shiftrightunsigned(column, 64 - FILTER_BITS)
    marked = (
        values.select(bit.alias("bit"))
        .selectExpr("shiftright(bit, 6) AS word", "shiftleft(1L, cast(bit & 63 AS int)) AS m")
        .groupBy("word")
        .agg(F.bit_or("m").alias("m"))
        .toArrow()
    )  # 2 ** (FILTER_BITS - 6) rows at most
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[marked["word"].to_numpy()] = marked["m"].to_numpy()
    return bits.view(np.uint64)


def _maybe_in(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values.view(np.uint64) >> np.uint64(64 - FILTER_BITS)
    return (bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)


def _signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(s, hi): every signature with half the name of its set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(percent)
        for batch in batches:
            found, names = [], []
            for text in batch.column("text").to_pylist():
                items = shingles(text, words)
                found.append(_joined([signatures for signatures, _ in parts.signatures(items)]))
                names.append(np.full(len(found[-1]), set_digest(items)[0], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(_joined(found)), pa.array(_joined(names))], ["s", "hi"])

    return docs.select("text").mapInArrow(run, "s long, hi long")


def _sets(docs: DataFrame, words: int, percent: int, repeated: DataFrame) -> DataFrame:
    """doc_id, n, hi, lo, signatures, sketch of every row: size and name of its set,
    those of its signatures that may be among the repeated ones, if they are as
    many as a similar set would share, and if there are any, its sketch."""
    asked = docs.sparkSession.sparkContext.broadcast(_filter_of(repeated, "s"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = Parts(percent)
        for batch in batches:
            found = [shingles(text, words) for text in batch.column("text").to_pylist()]
            named = [set_digest(items) for items in found]
            signatures = []
            for items in found:
                hits = [(s[_maybe_in(asked.value, s)], common) for s, common in parts.signatures(items)]
                signatures.append(_joined([s for s, common in hits if len(s) >= common]))
            sketches = [sketch(x).view(np.int64) if len(s) else s for x, s in zip(found, signatures, strict=True)]
            columns = ([len(items) for items in found], [d[0] for d in named], [d[1] for d in named])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns),
                 *(pa.array(c, pa.list_(pa.int64())) for c in (signatures, sketches))],
                ["doc_id", "n", "hi", "lo", "signatures", "sketch"],
            )

    schema = "doc_id long, n long, hi long, lo long, signatures array<long>, sketch array<long>"
    return stored(docs.mapInArrow(run, schema), "sets")


def _memberships(sets: DataFrame, nodes: DataFrame, repeated: DataFrame) -> DataFrame:
    """(leader, id) for every node that may have a partner."""
    postings = sets.select("hi", "lo", F.explode("signatures").alias("s")).join(repeated, "s").distinct()
    active = stored(postings.join(nodes.select("id", "hi", "lo"), ["hi", "lo"]).select("s", "id"), "active")
    degree = stored(active.groupBy("id").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    leads = stored(
        active.join(degree, "id")
        .groupBy("s")
        .agg(F.max(F.struct("degree", "id")).alias("lead"))
        .select("s", F.col("lead.id").alias("leader")),
        "leads",
    )
    return stored(active.join(leads, "s").select("leader", "id").distinct(), "memberships")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(id, items) of the wanted nodes (id, hi, lo), from a further pass over the texts."""
    asked = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted, "hi"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hi, lo, found = [], [], []
            for text in batch.column("text").to_pylist():
                items = shingles(text, words)
                digest = set_digest(items)
                if _maybe_in(asked.value, np.array([digest[0]]))[0]:
                    hi.append(digest[0])
                    lo.append(digest[1])
                    found.append(items.view(np.int64))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hi, pa.int64()), pa.array(lo, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                    ["hi", "lo", "items"],
                )

    sets = docs.select("text").mapInArrow(run, "hi long, lo long, items array<long>")
    one = sets.groupBy("hi", "lo").agg(F.first("items").alias("items"))
    return stored(wanted.join(one, ["hi", "lo"]).select("id", "n", "items"), "full-sets")


def _cells(memberships: DataFrame, sizes: DataFrame, most: int, label: str) -> DataFrame:
    """leader, i, j, id, own: the cells of every block (or group) of (leader, id) in
    which a node takes part, by chunks of the sizes (id, size) that add up to some `most`."""
    blocks = stored(
        memberships.join(sizes, "id")
        .groupBy("leader")
        .agg(F.count(F.lit(1)).alias("members"), F.ceil(F.sum("size") / most).cast("int").alias("chunks"))
        .where("members > 1")
        .select("leader", "chunks"),
        f"{label}-blocks",
    )
    placed = memberships.join(blocks, "leader").withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    # Every pair of chunks (i <= j) is a cell; a node goes to all cells of its
    # chunk, the leader to all cells of the block.
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    own_cells = F.transform(others, lambda k: F.struct(F.least("own", k).alias("i"), F.greatest("own", k).alias("j")))
    all_cells = F.flatten(
        F.transform(others, lambda i: F.transform(F.sequence(i, F.col("chunks") - 1), lambda j: F.struct(i.alias("i"), j.alias("j"))))
    )
    cells = placed.select(
        "leader", "id", "own", F.explode(F.when(F.col("id") == F.col("leader"), all_cells).otherwise(own_cells)).alias("cell")
    ).select("leader", "cell.i", "cell.j", "id", "own")
    return stored(cells, f"{label}-cells")


def _cell_members(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple]:
    """leader, i, j, id, own, size and the numbers of `column` of every row."""
    for batch in batches:
        keys = [batch.column(c).to_pylist() for c in ("leader", "i", "j", "id", "own", "n")]
        numbers = batch.column(column)
        flat = numbers.flatten().to_numpy().view(np.uint64)
        offsets = np.concatenate([[0], np.cumsum(numbers.value_lengths().to_numpy())])
        for k, key in enumerate(zip(*keys, strict=True)):
            yield (*key, flat[offsets[k] : offsets[k + 1]])


def _pairs_by_cell(rows: DataFrame, column: str, find: Callable, label: str) -> DataFrame:
    """Pairs (a, b) that `find` has in the cells of `rows`, given of each cell its
    leader and of its nodes ids, sides, sizes and the numbers of `column`."""
    dealt = rows.select("leader", "i", "j", "id", "own", "n", column).repartition("leader", "i", "j")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (leader, i, j), group in groupby(_cell_members(batches, column), key=lambda m: m[:3]):
            ids, sides, sizes, numbers = [], [], [], []
            for *_, node, own, n, x in group:
                ids.append(node)
                sides.append(0 if own == i else 1 if own == j else 2)
                sizes.append(n)
                numbers.append(x)
            found = find(leader, ids, sides, sizes, numbers) if len(ids) > 1 else []
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    with batches_of(rows.sparkSession, 256):
        return stored(dealt.sortWithinPartitions("leader", "i", "j", "id").mapInArrow(run, "a long, b long"), label)


def _groups(memberships: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(leader, id) for every node whose sketch lets it be similar to another's: the
    groups they connect, led by the node with most of the connecting pairs."""
    rows = _cells(memberships, nodes.select("id", F.size("sketch").alias("size")), CHUNK_WORDS, "sketch")

    def find(leader, ids, sides, sizes, sketches) -> list[tuple]:
        return near_in(ids, sizes, sketches, sides, percent)

    pairs = _pairs_by_cell(rows.join(nodes.select("id", "n", "sketch"), "id"), "sketch", find, "near")
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))
    found = stored(components(pairs).join(degree, "id"), "near-components")
    leads = found.groupBy("component").agg(F.max(F.struct("degree", "id")).alias("lead"))
    return stored(found.join(leads, "component").select(F.col("lead.id").alias("leader"), "id"), "groups")


def _links(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all similar nodes, group by group."""
    rows = _cells(groups, sets.select("id", F.col("n").alias("size")), CHUNK_SHINGLES, "set")

    def find(leader, ids, sides, sizes, items) -> list[tuple]:
        return links_in(ids, items, sides, leader, percent)

    return _pairs_by_cell(rows.join(sets, "id"), "items", find, "links")


def jaccard_components(
    docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id per row of `docs`.

    Two rows are linked if 100 * intersection >= percent * union of their sets
    of distinct shingles; component_id is the smallest doc_id reachable by
    links, the row's own included. Rows without any word have no shingle and no
    link. Rows that repeat a doc_id are rows of their own that share its name;
    a null doc_id is never the smallest beside a number. An empty table gives no
    row; other columns are not read.
    """
    if not 1 <= percent <= 100:
        raise ValueError("the similarity is a whole number of per cent")
    bounded_batches(docs.sparkSession)
    rows = texts(docs, id_column, text_column)
    # Copies of one set have the same hi, so they make no list of their own.
    lists = _signatures(rows, words, percent).groupBy("s").agg(F.min("hi").alias("low"), F.max("hi").alias("high"))
    repeated = stored(lists.where("low < high").select("s"), "repeated")
    sets = _sets(rows, words, percent, repeated)
    nodes = stored(
        sets.where("n > 0")
        .groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("sketch").alias("sketch"))
        .withColumn("id", F.monotonically_increasing_id()),
        "nodes",
    )
    groups = _groups(_memberships(sets, nodes, repeated), nodes, percent)
    wanted = stored(nodes.select("id", "hi", "lo", "n").join(groups, "id", "left_semi"), "wanted")
    links = _links(groups, _full_sets(rows, wanted, words), percent)
    found = stored(components(links), "components")
    grouped = nodes.select("id", "hi", "lo", "least").join(found, "id", "left")
    names = stored(
        grouped.where("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("component_id")), "names"
    )
    named = stored(
        grouped.join(names, "component", "left").select("hi", "lo", F.coalesce("component_id", "least").alias("component_id")),
        "named",
    )
    return sets.join(named, ["hi", "lo"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_similar(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """`docs` with one document of every group of linked ones, the smallest doc_id.

    Rows without a doc_id stay, as nothing names them; rows that repeat one share its fate.
    """
    found = jaccard_components(docs, words, percent)
    gone = stored(found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "similar-gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))
