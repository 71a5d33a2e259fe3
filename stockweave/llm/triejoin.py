"""Exact Jaccard join of documents' n-gram sets by prefix trees, as connected components.

A document's set holds its distinct windows of `words` words, with A-Z lowered, as 64-bit hashes;
a document with fewer words has one window of all of them. Two documents link when their sets
have Jaccard similarity `NUMERATOR / DENOMINATOR` or more. Equal sets, known by 128 bits, are one
node from the start.

*Who can link.* n-grams are ordered globally, rare ones first. Similar sets share one of the first
n - ceil(t n) + 1 n-grams of each, so a set of which fewer than ceil(t n) n-grams occur in any
other set links with none. What occurs in two sets is counted exactly: each task settles what its own
documents share and passes on the others, packed in 32 bits within as many buckets as the data
needs. Most documents end here. Among those left n-grams are counted again, put in order,
and sets that share one in their prefixes become candidates of each other.

*The join.* Sets that candidates connect make a block. In a block, sets are ordered by the frequency
of their n-grams there, most frequent first, and stored in a trie whose edges are the runs
of n-grams between branches. Each set then walks the trie: the overlap with a branch is counted once
for all sets below it, and a subtree is left when the overlap so far and what both sides
have left can't reach what its smallest set needs, or when all its sets are in the walker's
component already.

Blocks are of bounded size. Larger connected candidates are dealt to several, each with some common
sets. Prefix groups that then still hold several components are compared again, those outside
the largest component with all, in blocks of pairs of chunks. So no link is lost: the
sets of a link share a prefix group, which is either one component or compared throughout.

Null and empty texts, and texts without words, have an empty set and link with nothing. Rows
that repeat a doc_id are documents of their own which share its number. A null doc_id names a
component only if it has no other. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import Scratch, arrow_map, mix, slices, span_hashes, utf8, word_spans
from stockweave.llm.components import components

WORDS = 5
NUMERATOR, DENOMINATOR = 4, 5  # of the least similarity

BLOCK_GRAMS = 1 << 20  # n-grams and sets of a block at most, but for two sets in any case
BLOCK_SETS = 2048
COMMON = 8  # a chunk of larger candidates gets a further 1 / COMMON of sets common to all chunks
BUCKET_GRAMS = 1 << 20  # n-grams counted at once
BROADCAST_SETS = 1 << 21  # 64-bit hashes of texts that are sent to all tasks at most
RANGE_SETS = 1 << 16  # sets whose counts are added up at once
HELD_GRAMS = 1 << 20  # n-grams a task holds before it passes them on

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def needed(a, b):
    """The least overlap that makes sets of sizes a and b similar enough."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def grams(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 64-bit hash) of the distinct n-grams of each text, in this order."""
    raw, borders = utf8(column)
    raw = _LOWER[raw]
    starts, ends, owner = word_spans(raw, borders)
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=_U)
    hashes = span_hashes(raw, starts, ends)
    total = np.zeros(n, dtype=_U)
    whole = np.ones(n, dtype=bool)
    for j in range(words):
        same = np.zeros(n, dtype=bool)
        same[: n - j] = owner[j:] == owner[: n - j] if j else True
        part = mix(hashes[j:] + _U(j * 0x632BE59BD9B4E019 % (1 << 64)))
        total[: n - j] += np.where(same[: n - j], part, _U(0))
        whole &= same
    first = np.ones(n, dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = whole | first  # the first n-gram of a short text is all of it
    owner, total = owner[keep], mix(total[keep])
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])
    return owner[new], total[new]


def _starts(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))


def _names(total: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(sets x 2) 64-bit hashes of the sets that begin at `first`."""
    return np.stack(
        [mix(np.add.reduceat(mix(total + _U(salt)), first)) for salt in (0x7A15, 0xC0DE)], axis=1
    )


def _short(names: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(names[:, 0]) | _U(1)  # never _SHARED


def _described(rows: DataFrame, words: int) -> DataFrame:
    """(doc_id, content, node, name, n): the set's 128-bit name, 64 bits of it for the packed
    n-grams, and its size. The names of an empty set are null."""

    def describe(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, total = grams(batch.column("text"), words)
        node: list[bytes | None] = [None] * batch.num_rows
        short: list[int | None] = [None] * batch.num_rows
        size = np.bincount(owner, minlength=batch.num_rows)
        if len(owner):
            first = _starts(owner)
            names = _names(total, first)
            shorter = _short(names).view(np.int64).tolist()
            for k, i in enumerate(owner[first].tolist()):
                node[i], short[i] = names[k].tobytes(), shorter[k]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("content"),
                pa.array(node, pa.binary()), pa.array(short, pa.int64()),
                pa.array(size, pa.int64()),
            ],
            ["doc_id", "content", "node", "name", "n"],
        )

    return arrow_map(
        rows, describe, "doc_id long, content long, node binary, name long, n long"
    )


# Counting what occurs in two sets -------------------------------------------------------------

_SHARED = np.uint64(0)  # in place of a set: the n-gram is known to occur in two


def _packed(rows: DataFrame, words: int, buckets: int) -> DataFrame:
    """(bucket, sets, sizes, grams): n-grams by bucket, 32 bits each, in the order of `sets`.

    Bucket -1 has how many n-grams of its sets other sets of the same task have.
    """

    def pack(total: np.ndarray, name: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((name, total))
        total, name = total[order], name[order]
        new = np.ones(len(total), dtype=bool)
        new[1:] = (total[1:] != total[:-1]) | (name[1:] != name[:-1])  # copies of one set
        total, name = total[new], name[new]
        at = _starts(total)
        sets = np.diff(np.append(at, len(total)))
        alone = np.repeat(sets == 1, sets)
        mine, count = np.unique(name[~alone], return_counts=True)
        keep = alone.copy()
        keep[at] = True  # one row tells the others that an n-gram is shared
        name = np.where(alone, name, _SHARED)[keep]
        total = total[keep]
        bucket = ((total >> _U(32)) % _U(buckets)).astype(np.int64)
        order = np.lexsort((name, bucket))
        bucket, name, gram = bucket[order], name[order], total[order].astype("<u4")
        new = np.ones(len(bucket), dtype=bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (name[1:] != name[:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(bucket))).astype("<u4")
        cut = _starts(bucket[begin])
        edge = np.append(cut, len(begin)).tolist()
        where = np.append(begin, len(bucket))
        heads = name[begin].astype("<u8")
        spans = list(zip(edge[:-1], edge[1:], strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(bucket[begin[cut]], -1), pa.int32()),
                pa.array([*(heads[a:b].tobytes() for a, b in spans), mine.tobytes()], pa.binary()),
                pa.array(
                    [*(size[a:b].tobytes() for a, b in spans), count.astype("<u4").tobytes()],
                    pa.binary(),
                ),
                pa.array([*(gram[where[a] : where[b]].tobytes() for a, b in spans), b""], pa.binary()),
            ],
            ["bucket", "sets", "sizes", "grams"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for part in slices(batches):
            owner, total = grams(part.column("text"), words)
            if not len(owner):
                continue
            first = _starts(owner)
            name = _short(_names(total, first))
            held.append((total, np.repeat(name, np.diff(np.append(first, len(owner))))))
            size += len(total)
            if size > HELD_GRAMS:
                yield from pack(*(np.concatenate(c) for c in zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield from pack(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return rows.select("text").mapInArrow(
        run, "bucket int, sets binary, sizes binary, grams binary"
    )


def _shared_counts(packed: DataFrame, buckets: int, ranges: int) -> DataFrame:
    """(name, shared): how many n-grams of a set other sets have, at least; no set has less.

    Copies of a set in several tasks may have some counted twice, which only keeps a set for
    the exact steps that follow. Counts travel packed too, by `ranges` of names.
    """

    def parts_of(names: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
        at = (mix(names) % _U(ranges)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        at, names, total = at[order], names[order].astype("<u8"), total[order].astype("<u4")
        edge = np.append(_starts(at), len(at)).tolist() if len(at) else [0]
        spans = list(zip(edge[:-1], edge[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(at[a]) for a, _ in spans], pa.int32()),
                pa.array([names[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([total[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            ["range", "names", "totals"],
        )

    def count(parts: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
        heads = np.concatenate([np.frombuffer(p[0], dtype="<u8") for p in parts])
        sizes = np.concatenate([np.frombuffer(p[1], dtype="<u4") for p in parts])
        gram = np.concatenate([np.frombuffer(p[2], dtype="<u4") for p in parts])
        names, number = np.unique(heads, return_inverse=True)
        key = (gram.astype(_U) << _U(32)) | np.repeat(number, sizes).astype(_U)
        key = np.unique(key)
        gram, number = (key >> _U(32)).astype(np.int64), (key & _U(0xFFFFFFFF)).astype(np.int64)
        at = _starts(gram)
        sets = np.diff(np.append(at, len(gram)))
        flagged = names[number[at]] == _SHARED  # the smallest name
        shared = np.repeat((sets > 1) | flagged, sets) & (names[number] != _SHARED)
        total = np.bincount(number[shared], minlength=len(names))
        some = np.flatnonzero(total)
        return parts_of(names[some].astype(_U), total[some])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, bytes]] = []
        now = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "sets", "sizes", "grams")]
            for bucket, sets, sizes, gram in zip(*columns, strict=True):
                if bucket == -1:
                    yield parts_of(
                        np.frombuffer(sets, dtype="<u8").astype(_U),
                        np.frombuffer(sizes, dtype="<u4"),
                    )
                    continue
                if bucket != now and held:
                    yield count(held)
                    held = []
                now = bucket
                held.append((sets, sizes, gram))
        if held:
            yield count(held)

    def add(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        names, total = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.argsort(names)
        names = names[order]
        at = _starts(names)
        return names[at], np.add.reduceat(total[order], at)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for names, total in zip(
                batch.column("names").to_pylist(), batch.column("totals").to_pylist(), strict=True
            ):
                held.append(
                    (np.frombuffer(names, "<u8"), np.frombuffer(total, "<u4").astype(np.int64))
                )
                size += len(held[-1][0])
                if size > 4 * HELD_GRAMS:
                    held = [add(held)]
                    size = len(held[0][0]) // 2
        if held:
            names, total = add(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.astype(_U).view(np.int64)), pa.array(total)], ["name", "shared"]
            )

    # rows without a bucket, one a task, are spread
    place = F.when(F.col("bucket") < 0, F.xxhash64("sets") % buckets).otherwise(F.col("bucket"))
    return (
        packed.repartition(buckets, place)
        .sortWithinPartitions("bucket")
        .mapInArrow(run, "range int, names binary, totals binary")
        .repartition(ranges, "range")
        .mapInArrow(sums, "name long, shared long")
    )


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(set, n, grams array<long>) of the rows of (set, text)."""

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, total = grams(batch.column("text"), words)
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
        kept = total.view(np.int64)
        lists = [kept[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("set"),
                pa.array(np.diff(cuts), pa.int64()),
                pa.array(lists, pa.list_(pa.int64())),
            ],
            ["set", "n", "grams"],
        )

    return arrow_map(rows, build, "set binary, n long, grams array<long>")


def _prefixes(sets: DataFrame) -> DataFrame:
    """(gram, node): the n-grams by which a set is found, of those that two sets have."""
    listed = sets.select("node", F.explode("grams").alias("gram"))
    counts = listed.groupBy("gram").agg(F.count("*").alias("sets")).filter("sets > 1")
    ordered = (
        listed.join(counts, "gram")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("sets", "gram"))).alias("shared"))
    )
    least = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
    return (
        ordered.join(sets.select("node", "n"), "node")
        .withColumn("taken", (F.size("shared") - least + 1).cast("int"))
        .filter(F.col("taken") > 0)
        .select("node", F.explode(F.slice("shared", 1, F.col("taken"))).alias("at"))
        .select(F.col("at.gram").alias("gram"), "node")
    )


# The trie ---------------------------------------------------------------------------------------


class Trie:
    """Sets of one block, most frequent n-grams first, with edges for runs without a branch."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets], dtype=np.int64)
        every = np.concatenate(sets)
        gram, number, count = np.unique(every, return_inverse=True, return_counts=True)
        rank = np.empty(len(gram), dtype=np.int64)
        rank[np.lexsort((gram, -count))] = np.arange(len(gram))
        self.vocabulary = int((count > 1).sum())  # what one set has alone adds to no overlap
        ranks = rank[number]
        cut = np.cumsum(self.n)[:-1]
        trimmed = [np.sort(r[r < self.vocabulary]) for r in np.split(ranks, cut)]
        self.order = sorted(range(len(sets)), key=lambda i: trimmed[i].astype(">u4").tobytes())
        self.paths = [trimmed[i] for i in self.order]
        self.n = self.n[self.order]
        self.length = np.array([len(p) for p in self.paths], dtype=np.int64)
        self.flat = np.concatenate(self.paths) if self.vocabulary else np.zeros(0, np.int64)
        self.offset = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self._grow()

    def _common(self, i: int) -> int:
        a, b = self.paths[i - 1], self.paths[i]
        m = min(len(a), len(b))
        differ = np.flatnonzero(a[:m] != b[:m])
        return int(differ[0]) if len(differ) else m

    def _grow(self) -> None:
        # of a node: depth at which its edge starts and ends, a set that has the edge, the
        # sets below it, its parent
        start, end, having, low, high, parent = [0], [0], [0], [0], [0], [-1]
        self.last = np.zeros(len(self.paths), dtype=np.int64)  # the node a set ends at
        open_nodes = [0]

        def node(*values: int) -> int:
            for column, value in zip((start, end, having, low, high, parent), values, strict=True):
                column.append(value)
            return len(start) - 1

        for i, path in enumerate(self.paths):
            common = self._common(i) if i else 0
            closed = None
            while end[open_nodes[-1]] > common:
                closed = open_nodes.pop()
                high[closed] = i
            if end[open_nodes[-1]] < common:  # the edge that was closed last gets a branch
                made = node(start[closed], common, having[closed], low[closed], 0, open_nodes[-1])
                start[closed], parent[closed] = common, made
                open_nodes.append(made)
            if len(path) > common:
                open_nodes.append(node(common, len(path), i, i, 0, open_nodes[-1]))
            self.last[i] = open_nodes[-1]
        for k in open_nodes:
            high[k] = len(self.paths)
        self.start, self.end, self.having, self.low, self.high, parent = (
            np.array(c, dtype=np.int64) for c in (start, end, having, low, high, parent)
        )
        self.least = np.array([self.n[a:b].min() for a, b in zip(low, high, strict=True)])
        self.longest = np.array([self.length[a:b].max() for a, b in zip(low, high, strict=True)])
        by_parent = np.argsort(parent, kind="stable")
        self.children = by_parent[1:]  # the root has none above it
        self.child = np.searchsorted(parent[by_parent], np.arange(len(parent) + 1)) - 1
        self.ending = self.flat[self.offset[self.having] + self.end - 1] if len(self.flat) else None

    @staticmethod
    def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Positions begin[i] .. begin[i] + size[i] - 1 of all i, one after another."""
        done = np.cumsum(size) - size
        return np.arange(int(size.sum())) + np.repeat(begin - done, size)

    def walk(self, q: int, wanted: np.ndarray) -> np.ndarray:
        """The sets that are wanted and similar to set q (positions in trie order)."""
        mine, a = self.paths[q], self.n[q]
        has = np.zeros(self.vocabulary, dtype=np.int64)
        has[mine] = 1
        below = np.concatenate([[0], np.cumsum(wanted)])
        overlap = np.full(len(self.start), -1, dtype=np.int64)
        nodes = self.children[self.child[0] : self.child[1]]
        so_far = np.zeros(len(nodes), dtype=np.int64)
        while len(nodes):
            keep = below[self.high[nodes]] > below[self.low[nodes]]
            nodes, so_far = nodes[keep], so_far[keep]
            if not len(nodes):
                break
            size = self.end[nodes] - self.start[nodes]
            places = self._ranges(self.offset[self.having[nodes]] + self.start[nodes], size)
            so_far = so_far + np.add.reduceat(has[self.flat[places]], np.cumsum(size) - size)
            left = np.minimum(
                len(mine) - np.searchsorted(mine, self.ending[nodes], "right"),
                self.longest[nodes] - self.end[nodes],
            )
            keep = so_far + left >= needed(a, self.least[nodes])
            nodes, so_far = nodes[keep], so_far[keep]
            overlap[nodes] = so_far
            size = self.child[nodes + 1] - self.child[nodes]
            so_far = np.repeat(so_far, size)
            nodes = self.children[self._ranges(self.child[nodes], size)]
        return np.flatnonzero(wanted & (overlap[self.last] >= needed(a, self.n)))


def link(sets: list[np.ndarray], label: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of positions, all similar, that connect what the links among `sets` connect.

    Sets with equal labels count as connected already.
    """
    trie = Trie(sets)
    label = label[trie.order]
    found = []
    for q in range(len(sets)):
        wanted = label != label[q]
        wanted[: q + 1] = False
        if not wanted.any():
            continue
        for i in trie.walk(q, wanted).tolist():
            if label[i] != label[q]:
                found.append((trie.order[q], trie.order[i]))
                label[label == label[i]] = label[q]
    return found


def _joined(rows: DataFrame) -> DataFrame:
    """(u, v): links that connect the sets of each block; `rows` has (block, node, label, grams)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        now = None

        def links() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            nodes = list(held)
            _, label = np.unique([held[x][0] for x in nodes], return_inverse=True)
            pairs = link([held[x][1] for x in nodes], label)
            yield pa.RecordBatch.from_arrays(
                [pa.array([nodes[p[k]] for p in pairs], pa.int64()) for k in (0, 1)], ["u", "v"]
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "node", "label")]
            lists = batch.column("grams")
            for i, (block, node, label) in enumerate(zip(*columns, strict=True)):
                if block != now:
                    yield from links()
                    held, now = {}, block
                held[node] = label, lists[i].values.to_numpy().view(_U)
        yield from links()

    return (
        rows.repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(run, "u long, v long")
    )


def _chunks(grams_: Column, sets: Column, block_grams: int, block_sets: int) -> Column:
    return F.greatest(
        F.ceil(grams_ / F.lit(block_grams)), F.ceil(sets / F.lit(block_sets)), F.lit(1)
    ).cast("int")


def _chunk(count: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64("node", F.lit(salt)), count).cast("int")


def _every(count: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), count - 1))


def _block(*parts: str) -> Column:
    return F.concat_ws("-", *(F.col(p).cast("string") for p in parts))


def _links(
    sets: DataFrame, scratch: Scratch, block_grams: int, block_sets: int
) -> DataFrame:
    """(u, v): links that connect what all links among `sets` connect."""
    prefixes = scratch.store(_prefixes(sets), "prefixes")
    leaders = prefixes.groupBy("gram").agg(F.min("node").alias("u"), F.count("*").alias("sets"))
    found = prefixes.join(leaders.filter("sets > 1"), "gram")
    near = components(found.select("u", F.col("node").alias("v")).distinct())
    near = near.withColumnRenamed("label", "part")
    sized = near.join(sets.select("node", "n"), "node")
    parts = sized.groupBy("part").agg(
        _chunks(F.sum("n"), F.count("*"), block_grams, block_sets).alias("chunks")
    )
    parts = scratch.store(parts, "parts")
    placed = near.join(parts, "part")
    common = placed.filter(
        (F.col("chunks") > 1) & (_chunk(F.col("chunks") * COMMON, 7) == 0)
    ).select("node", "part", _every(F.col("chunks")).alias("chunk"))
    dealt = placed.select("node", "part", _chunk(F.col("chunks"), 1).alias("chunk"))
    dealt = dealt.unionByName(common).distinct()
    block = _block("part", "chunk")
    first = scratch.store(
        _joined(
            dealt.join(sets, "node").select(
                block.alias("block"), "node", F.col("node").alias("label"), "grams"
            )
        ),
        "links",
    )
    large = parts.filter("chunks > 1")
    if not large.head(1):
        return first

    # what was dealt to several blocks: groups that hold several components are compared again
    label = components(first).withColumnRenamed("node", "of")
    members = (
        found.join(near, "node").join(large, "part")
        .join(sets.select("node", "n"), "node")
        .join(label, F.col("node") == F.col("of"), "left")
        .select("gram", "node", "n", F.coalesce("label", "node").alias("label"))
    )
    members = scratch.store(members, "members")
    by_label = members.groupBy("gram", "label").agg(F.count("*").alias("sets"))
    mixed = by_label.groupBy("gram").agg(
        F.max_by("label", "sets").alias("main"), F.count("*").alias("labels")
    )
    mixed = members.join(mixed.filter("labels > 1"), "gram")
    other = F.col("label") != F.col("main")
    lists = mixed.groupBy("gram").agg(
        F.bit_xor(F.xxhash64("node", F.lit(3))).alias("x"),
        F.bit_xor(F.xxhash64("node", F.lit(4))).alias("y"),
        _chunks(F.sum("n"), F.count("*"), block_grams, block_sets).alias("chunks"),
        _chunks(
            F.sum(F.when(other, F.col("n"))), F.count_if(other), block_grams, block_sets
        ).alias("others"),
    )
    # groups with the same sets are compared once
    lists = lists.groupBy("x", "y").agg(F.min_by(F.struct("gram", "chunks", "others"), "gram").alias("g"))
    rows = mixed.join(lists.select("g.*"), "gram")
    across = rows.select(
        "gram", "node", "label", _chunk(F.col("chunks"), 5).alias("j"), _every(F.col("others")).alias("i")
    ).unionByName(
        rows.filter(other).select(
            "gram", "node", "label", _chunk(F.col("others"), 6).alias("i"),
            _every(F.col("chunks")).alias("j"),
        )
    )
    block = _block("gram", "i", "j")
    second = _joined(
        across.distinct().join(sets.select("node", "grams"), "node").select(
            block.alias("block"), "node", "label", "grams"
        )
    )
    return first.unionByName(scratch.store(second, "links"))


def link_components(
    docs: DataFrame,
    words: int = WORDS,
    block_grams: int = BLOCK_GRAMS,
    block_sets: int = BLOCK_SETS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, copies): one row per row of `docs`.

    `component_id` is the smallest doc_id that links reach. `copies` counts the rows with an
    equal set, this one included.
    """
    spark = docs.sparkSession
    value = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        docs[doc_id].cast("long").alias("doc_id"), F.xxhash64(value).alias("content"),
        value.alias("text"),
    )
    described = durable(_described(rows, words), "sets")
    nodes = (
        described.filter(F.col("node").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("name").alias("name"),
            F.min(F.struct("doc_id", "content")).alias("row"),
        )
    )
    with Scratch(spark) as scratch:
        nodes = scratch.store(nodes, "nodes")
        size = nodes.agg(F.sum("n").alias("n"), F.count("*").alias("sets")).first()
        buckets = max(1, math.ceil((size["n"] or 0) / BUCKET_GRAMS))
        ranges = max(1, math.ceil(size["sets"] / RANGE_SETS))
        shared = _shared_counts(_packed(rows, words, buckets), buckets, ranges)
        least = F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)
        wanted = scratch.store(
            nodes.join(shared, "name").filter(F.col("shared") >= least).select(
                F.col("node").alias("set"), F.col("row.doc_id").alias("of"),
                F.col("row.content").alias("at"),
            ),
            "wanted",
        )
        # few texts are wanted as a rule; where their hashes fit, no other text is moved
        if wanted.count() <= BROADCAST_SETS:
            hashes = F.broadcast(wanted.select(F.col("at").alias("content")).distinct())
            rows = rows.join(hashes, "content", "left_semi")
        texts = rows.join(
            wanted, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("content") == F.col("at"))
        ).groupBy("set").agg(F.first("text").alias("text"))  # a row may repeat
        # from here on a set is known by a number
        sets = _sets(texts, words).withColumn("node", F.monotonically_increasing_id())
        sets = scratch.store(sets, "grams")
        label = components(_links(sets, scratch, block_grams, block_sets))
        linked = (
            label.join(sets.select("node", F.col("set")), "node")
            .join(nodes.select(F.col("node").alias("set"), "least"), "set")
            .select("set", "label", "least")
        )
        names = linked.groupBy("label").agg(F.min("least").alias("component_id"))
        linked = linked.join(names, "label").select(F.col("set").alias("node"), "component_id")
        known = nodes.join(linked, "node", "left").select(
            "node", "copies", "least", F.coalesce("component_id", "least").alias("component_id")
        )
        known = durable(
            known.filter(
                (F.col("copies") > 1) | ~F.col("least").eqNullSafe(F.col("component_id"))
            ).drop("least"),
            "components",
        )
    return described.join(known, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.when(F.col("node").isNotNull(), F.coalesce("copies", F.lit(1))).alias("copies"),
    )


SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT nr, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
  END AS grams
  FROM words
), sized AS (
  SELECT nr, doc_id, len(grams) AS n FROM sets
), flat AS (
  SELECT nr, unnest(grams) AS gram FROM sets
), shared AS (
  SELECT a.nr AS x, b.nr AS y, count(*) AS c
  FROM flat a JOIN flat b ON a.gram = b.gram AND a.nr <> b.nr GROUP BY a.nr, b.nr
), links AS (
  SELECT x, y FROM shared JOIN sized a ON a.nr = x JOIN sized b ON b.nr = y
  WHERE 100 * c >= 80 * (a.n + b.n - c)
), reached AS (
  SELECT nr, nr AS other FROM sets
  UNION
  SELECT r.nr, l.y FROM reached r JOIN links l ON l.x = r.other
)
SELECT s.doc_id, s.n AS n_shingles, min(o.doc_id) AS component_id
FROM sized s JOIN reached r ON r.nr = s.nr JOIN sized o ON o.nr = r.other
GROUP BY s.nr, s.doc_id, s.n
"""
