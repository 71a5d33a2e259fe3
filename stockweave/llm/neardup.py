"""Near-duplicates by consistent weighted sampling, banded and verified.

A text, lowered, is the multiset of its windows of five words (one window of all its words if
it has fewer). A window weighs its count times a damped inverse document frequency between 1
and 2. Document frequencies cover all documents, in a count-min sketch of fixed size. Improved
consistent weighted sampling (Ioffe 2010) draws `BANDS` * `ROWS` samples per text, so that two
texts draw alike with the probability of their weighted Jaccard similarity. Texts that agree in
all samples of a band share a bucket; links are pairs of a bucket whose exact weighted Jaccard
similarity is `threshold` or more. Classes are the connected components of the links.

Copies (equal multisets) collapse to one node before anything is grouped. In a bucket, all
nodes are compared with one leader first. Buckets that hold nodes of several classes then are
compared in blocks, which return what is connected and no pairs. No pair of nodes of a bucket
that are in different classes is left out. A pair
with similarity 0.8 shares no bucket with probability (1 - 0.8^ROWS)^BANDS, 2e-4.

Texts without words, null or empty, are classes of their own. A class is named by its smallest
doc_id, which is also its representative. Rows that agree in doc_id and text are one document; rows
that share a doc_id only are several, in classes by their texts. Rows without doc_id take part and
never represent a class that has one. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import (
    Scratch,
    arrow_map,
    as_signed,
    mix,
    slices,
    span_hashes,
    utf8,
    word_spans,
)
from stockweave.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS = 12
ROWS = 3

BLOCK = 768  # nodes of a bucket compared at once with as many others

SKETCH_BITS = 18  # counters per row of the sketch, as a power of two
SKETCH_ROWS = 2
_CHUNK = 1 << 14
_FAN_IN = 64

_U = np.uint64
_MULTIPLIERS = mix(np.arange(1, BANDS * ROWS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)) | _U(1)


def features(
    column: pa.Array, words: int = WORDS, which: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, 64-bit window, count) of the distinct windows, by text, then window.
    `which` (0 or 1) picks one of two hash functions."""
    raw, borders = utf8(pc.utf8_lower(column))
    starts, ends, owner = word_spans(raw, borders)
    n = len(starts)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty.astype(_U), empty
    hashes = span_hashes(raw, starts, ends, which)
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
    keep = whole | first  # the first window of a short text is all of it
    owner, total = owner[keep], mix(total[keep])
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])
    at = np.flatnonzero(new)
    return owner[at], total[at], np.diff(np.append(at, len(owner)))


def _counters(windows: np.ndarray) -> list[np.ndarray]:
    """The counter of each window in each row of the sketch."""
    h = mix(windows)
    shift = _U(64 - SKETCH_BITS)
    return [((h * m) >> shift).astype(np.int64) for m in _MULTIPLIERS[:SKETCH_ROWS]]


def document_frequencies(rows: DataFrame, words: int = WORDS) -> np.ndarray:
    """The sketch: for each row and counter, in how many texts its windows occur.

    Each task counts its own texts; the counts are summed by chunks of the sketch, `_FAN_IN`
    tasks at a time, so a group never holds more than that many chunks.
    """
    width = 1 << SKETCH_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros((SKETCH_ROWS, width), dtype=np.int64)
        task = 0
        for part in slices(batches):
            task = part.column("task")[0].as_py()
            _, windows, _ = features(part.column("text"), words)
            for row, at in zip(sketch, _counters(windows), strict=True):
                row += np.bincount(at, minlength=width)
        chunks = sketch.reshape(-1, _CHUNK)
        if chunks.any():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(chunks), task), pa.int64()),
                    pa.array(np.arange(len(chunks)), pa.int64()),
                    pa.array([c.tobytes() for c in chunks], pa.binary()),
                ],
                ["task", "chunk", "counts"],
            )

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(_CHUNK, dtype=np.int64)
        for c in group["counts"]:
            total += np.frombuffer(c, dtype=np.int64)
        return pd.DataFrame({"task": [key[0]], "chunk": [key[1]], "counts": [total.tobytes()]})

    schema = "task long, chunk long, counts binary"
    sums = durable(
        rows.select(F.spark_partition_id().cast("long").alias("task"), "text").mapInArrow(
            count, schema
        ),
        "sketch",
    )
    tasks = (sums.agg(F.max("task")).first()[0] or 0) + 1
    while True:
        sums = (
            sums.withColumn("task", F.floor(F.col("task") / _FAN_IN))
            .groupBy("task", "chunk")
            .applyInPandas(add, schema)
        )
        tasks = math.ceil(tasks / _FAN_IN)
        if tasks == 1:
            break
    out = np.zeros((SKETCH_ROWS * width // _CHUNK, _CHUNK), dtype=np.int64)
    for r in sums.collect():  # the sketch, of fixed size
        out[r["chunk"]] = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    return out.reshape(SKETCH_ROWS, width)


def damped_idf(sketch: np.ndarray, documents: int) -> np.ndarray:
    """1 + log((1 + N) / (1 + df)) / log(1 + N), between 1 and 2, per counter."""
    full = math.log(1 + documents) or 1.0
    seen = np.minimum(sketch, documents)
    return (1 + (math.log(1 + documents) - np.log1p(seen)) / full).astype(np.float32)


def weights(windows: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights of windows; the sketch's rows overcount, so the largest idf is the best."""
    best = None
    for row, at in zip(idf, _counters(windows), strict=True):
        best = row[at] if best is None else np.maximum(best, row[at])
    return counts.astype(np.float32) * best


def _gamma_table() -> np.ndarray:
    """65,536 quantiles of the Gamma(2, 1) distribution: 1 - (1 + x) exp(-x) = p."""
    p = (np.arange(65536) + 0.5) / 65536
    low, high = np.zeros(65536), np.full(65536, 40.0)
    for _ in range(60):
        x = (low + high) / 2
        below = 1 - (1 + x) * np.exp(-x) < p
        low, high = np.where(below, x, low), np.where(below, high, x)
    return ((low + high) / 2).astype(np.float32)


_tables: list[np.ndarray] = []


def band_hashes(
    owner: np.ndarray, windows: np.ndarray, weight: np.ndarray, bands: int, rows: int
) -> np.ndarray:
    """A 64-bit hash per text that occurs in `owner` and band, from `rows` weighted samples each."""
    if not _tables:
        gamma = _gamma_table()
        _tables.extend([gamma, np.log(gamma), (1 / gamma).astype(np.float32)])
    gamma, log_gamma, inverse = _tables
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    sizes = np.diff(np.concatenate([first, [len(owner)]]))
    number = np.repeat(np.arange(len(first)), sizes)
    base, log_weight = mix(windows + _U(1)), np.log(weight)
    out = np.empty((len(first), bands), dtype=_U)
    for band in range(bands):
        code = np.full(len(first), band + 1, dtype=_U)
        for row in range(rows):
            z = base * _MULTIPLIERS[band * rows + row]
            z ^= z >> _U(32)
            z *= _U(0xBF58476D1CE4E5B9)
            z16 = z.view(np.uint16).reshape(-1, 4)
            r_at = z16[:, 3]
            beta = z16[:, 2].astype(np.float32) * np.float32(1 / 65536)
            t = np.floor(log_weight * inverse[r_at] + beta)
            log_a = log_gamma[z16[:, 1]] - gamma[r_at] * (t - beta + np.float32(1))
            least = np.minimum.reduceat(log_a, first)
            at = np.flatnonzero(log_a == np.repeat(least, sizes))[::-1]
            chosen = np.empty(len(first), dtype=np.int64)
            chosen[number[at]] = at  # of equals, the first
            step = t[chosen].astype(np.int32).view(np.uint32).astype(_U)
            code = mix(code + mix(windows[chosen] + step * _U(0xD6E8FEB86659FD93)))
        out[:, band] = code
    return out


def _packed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, doc_id, text)"""
    value = F.coalesce(docs[text], F.lit(""))
    number = docs[doc_id].cast("long")
    return docs.select(_key(number, value).alias("key"), number.alias("doc_id"), value.alias("text"))


def _key(number: Column, value: Column) -> Column:
    """Rows are one document if they agree in doc_id, null or not, and text."""
    return F.concat_ws(" ", F.coalesce(number.cast("string"), F.lit("null")), F.md5(value))


def _sketches(rows: DataFrame, idf, words: int, bands: int, per_band: int) -> DataFrame:
    """(key, doc_id, node, weight, bands): the node is a 128-bit hash of the multiset, null if
    that is empty; the weight is its total."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, windows, counts = features(batch.column("text"), words)
        n = batch.num_rows
        nodes: list[bytes | None] = [None] * n
        made: list[list[int] | None] = [None] * n
        total = np.zeros(n)
        if len(owner):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            names = _content_hashes(batch.column("text"), words, (owner, windows, counts))
            weight = weights(windows, counts, idf.value)
            hashes = as_signed(band_hashes(owner, windows, weight, bands, per_band))
            total[owner[first]] = np.add.reduceat(weight.astype(np.float64), first)
            for k, i in enumerate(owner[first].tolist()):
                nodes[i] = names[k]
                made[i] = hashes[k]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key"),
                batch.column("doc_id"),
                pa.array(nodes, pa.binary()),
                pa.array(total),
                pa.array(made, pa.list_(pa.int64())),
            ],
            ["key", "doc_id", "node", "weight", "bands"],
        )

    schema = "key string, doc_id long, node binary, weight double, bands array<long>"
    return arrow_map(rows, sketch, schema)


def _content_hashes(
    texts: pa.Array, words: int, found: tuple[np.ndarray, np.ndarray, np.ndarray]
) -> list[bytes]:
    """128 bits for the multiset of each text that has words: its windows hashed in two ways."""
    halves = []
    for owner, windows, counts in (found, features(texts, words, 1)):
        first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        halves.append(mix(np.add.reduceat(mix(windows + mix(counts.astype(_U))), first)))
    return [row.tobytes() for row in np.stack(halves, axis=1)]


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(node, windows, counts) as little-endian 64-bit and 32-bit numbers, sorted by window."""

    def build(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, windows, counts = features(batch.column("text"), words)
        cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1)).tolist()
        w, c = windows.astype("<u8"), counts.astype("<u4")
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("node"),
                pa.array([w[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([c[a:b].tobytes() for a, b in spans], pa.binary()),
            ],
            ["node", "windows", "counts"],
        )

    return arrow_map(rows, build, "node binary, windows binary, counts binary")


def similarity(
    a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], idf: np.ndarray
) -> float:
    """Weighted Jaccard similarity of two multisets (windows, counts), windows sorted."""
    wa = weights(a[0], a[1], idf).astype(np.float64)
    wb = weights(b[0], b[1], idf).astype(np.float64)
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(wa[i], wb[j]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _verified(pairs: DataFrame, sets: DataFrame, idf, threshold: float) -> DataFrame:
    """The `pairs` (u, v) that are similar enough. Each set travels once per pair it is in."""
    left = sets.select(
        F.col("node").alias("u"), F.col("windows").alias("uw"), F.col("counts").alias("uc")
    )
    right = sets.select(
        F.col("node").alias("v"), F.col("windows").alias("vw"), F.col("counts").alias("vc")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def numbers(value: pa.Scalar, kind: str) -> np.ndarray:
            return np.frombuffer(value.as_buffer(), dtype=kind)

        for batch in batches:
            good = []
            for k in range(batch.num_rows):
                sides = [
                    (
                        numbers(batch.column(w)[k], "<u8").astype(_U),
                        numbers(batch.column(c)[k], "<u4").astype(np.int64),
                    )
                    for w, c in (("uw", "uc"), ("vw", "vc"))
                ]
                good.append(similarity(*sides, idf.value) >= threshold)
            yield batch.select(["u", "v"]).filter(pa.array(good, pa.bool_()))

    # the many rows of a hot leader are split by adaptive execution: no window, no grouping
    return pairs.join(right, "v").join(left, "u").mapInArrow(check, "u binary, v binary")


def linked_groups(
    sets: list[tuple[np.ndarray, np.ndarray]],
    apart: np.ndarray,
    idf: np.ndarray,
    threshold: float,
) -> np.ndarray:
    """The smallest position each set is connected with by links; `apart` has the pairs to test.

    All similarities at once: every copy of a window is a feature of its own, so what two sets
    share is a product of matrices over the features that occur twice or more.
    """
    n = len(sets)
    windows = np.concatenate([w for w, _ in sets])
    counts = np.concatenate([c for _, c in sets])
    owner = np.repeat(np.arange(n), [len(w) for w, _ in sets])
    one = weights(windows, np.ones(len(windows), dtype=np.int64), idf).astype(np.float64)
    total = np.bincount(owner, weights=one * counts, minlength=n)
    at = np.repeat(np.arange(len(windows)), counts)
    copy = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
    features, column, times = np.unique(
        mix(windows[at] + mix(copy.astype(_U))), return_inverse=True, return_counts=True
    )
    keep = times[column] > 1
    order = np.argsort(column[keep], kind="stable")
    column, at = column[keep][order], at[keep][order]
    column = np.cumsum(np.concatenate([[0], np.diff(column) > 0])) if len(column) else column
    shared = np.zeros((n, n))
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        a, b = np.searchsorted(column, [start, start + 1024])
        part = np.zeros((n, 1024))
        part[owner[at[a:b]], column[a:b] - start] = np.sqrt(one[at[a:b]])
        shared += part @ part.T
    both = total[:, None] + total[None, :] - shared
    near = apart & (shared >= (threshold - 1e-9) * both)
    sure = shared >= (threshold + 1e-9) * both
    for i, j in np.argwhere(near & ~sure):  # as close to the threshold as rounding
        near[i, j] = near[j, i] = similarity(sets[i], sets[j], idf) >= threshold
    label = np.arange(n)
    while True:
        best = np.minimum(label, np.where(near, label[None, :], n).min(axis=1))
        best = best[best]
        if (best == label).all():
            return label
        label = best


def _block_links(open_: DataFrame, sets: DataFrame, idf, threshold: float) -> DataFrame:
    """Links (u, v) that connect what is similar among the nodes (bucket, band, node, label, n).

    The nodes of a bucket are dealt to blocks of about BLOCK; a task compares two blocks, and
    returns at most one row for each of their nodes, not pairs.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    other = F.col("other")
    dealt = (
        open_.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("low", F.least("block", other))
        .withColumn("high", F.greatest("block", other))
        .drop("n", "other")
    )

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        node, label, block = (group.column(c).to_pylist() for c in ("node", "label", "block"))
        found = [
            (
                np.frombuffer(w.as_buffer(), dtype="<u8").astype(_U),
                np.frombuffer(c.as_buffer(), dtype="<u4").astype(np.int64),
            )
            for w, c in zip(group.column("windows"), group.column("counts"), strict=True)
        ]
        number = np.unique(np.array(label, dtype=object), return_inverse=True)[1]
        apart = number[:, None] != number[None, :]
        if key[2].as_py() != key[3].as_py():  # pairs inside a block are compared elsewhere
            block = np.array(block)
            apart &= block[:, None] != block[None, :]
        group_of = linked_groups(found, apart, idf.value, threshold)
        rows = [(node[g], node[i]) for i, g in enumerate(group_of.tolist()) if g != i]
        u, v = zip(*rows, strict=True) if rows else ((), ())
        return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})

    return (
        dealt.join(sets, "node")
        .groupBy("bucket", "band", "low", "high")
        .applyInArrow(compare, "u binary, v binary")
    )


def _linked_labels(
    members: DataFrame,
    wanted: DataFrame,
    sets: DataFrame,
    idf,
    threshold: float,
    scratch: Scratch,
) -> DataFrame:
    """(node, label) of the nodes that share a bucket: components of the links among them.

    First every bucket's nodes are compared with one leader: the node of the highest degree, as
    the text that copies were made from is like all of them. Buckets that then hold nodes of
    several classes are compared in blocks. Pairs whose weights alone rule out the similarity
    (min / max is an upper bound of it) need no comparison with a leader.
    """

    def labelled_by(links: DataFrame) -> DataFrame:
        joined = wanted.join(components(links), "node", "left")
        return scratch.store(joined.withColumn("label", F.coalesce("label", "node")), "labels")

    rows = members.join(wanted, "node")
    leader = F.max_by(F.struct("node", "weight"), F.struct("degree", "node")).alias("leader")
    leaders = rows.groupBy("bucket", "band").agg(leader)
    light, heavy = (f("weight", "leader.weight") for f in (F.least, F.greatest))
    pairs = (
        rows.join(leaders, ["bucket", "band"])
        .filter((F.col("node") != F.col("leader.node")) & (light >= threshold * heavy))
        .select(F.col("leader.node").alias("u"), F.col("node").alias("v"))
        .distinct()
    )
    links = scratch.store(_verified(pairs, sets, idf, threshold), "links")
    labels = labelled_by(links)
    labelled = scratch.store(
        members.join(labels.select("node", "label"), "node"), "labelled"
    )
    mixed = (
        labelled.groupBy("bucket", "band")
        .agg(
            F.count("*").alias("n"),
            F.min("label").alias("first"),
            F.max("label").alias("last"),
        )
        .filter(F.col("first") != F.col("last"))
        .select("bucket", "band", "n")
    )
    open_ = labelled.join(mixed, ["bucket", "band"])
    more = scratch.store(_block_links(open_, sets, idf, threshold), "more-links")
    return labelled_by(links.unionAll(more)).select("node", "label")


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    bands: int = BANDS,
    rows: int = ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, doc_id, class_id, class_size, kept), one row per row of `docs`."""
    if bands * rows > len(_MULTIPLIERS):
        raise ValueError(f"at most {len(_MULTIPLIERS)} samples")
    spark = docs.sparkSession
    named = _packed(docs, doc_id, text)
    sketch = document_frequencies(named, words)
    documents = named.count()
    idf = spark.sparkContext.broadcast(damped_idf(sketch, documents))
    with Scratch(spark) as scratch:
        sketched = scratch.store(_sketches(named, idf, words, bands, rows), "sketches")

        nodes = scratch.store(
            sketched.filter("node IS NOT NULL")
            .groupBy("node")
            .agg(
                F.min("key").alias("key"),
                F.any_value("weight").alias("weight"),
                F.any_value("bands").alias("bands"),
            ),
            "nodes",
        )
        buckets = nodes.select("node", F.posexplode("bands").alias("band", "bucket"))
        shared = buckets.groupBy("bucket", "band").agg(F.count("*").alias("n")).filter("n > 1")
        members = scratch.store(buckets.join(shared, ["bucket", "band"]), "members")
        # a node that is like many others meets them in large buckets
        wanted = scratch.store(
            members.groupBy("node")
            .agg(F.sum("n").alias("degree"))
            .join(nodes.select("node", "key", "weight"), "node"),
            "wanted",
        )
        sets = scratch.store(
            _sets(
                named.select("key", "text")
                .join(wanted.select("key", "node"), "key")
                .select("node", "text"),
                words,
            ).dropDuplicates(["node"]),
            "sets",
        )
        labels = _linked_labels(
            members.select("bucket", "band", "node"), wanted, sets, idf, threshold, scratch
        )
        classes = sketched.select("key", "doc_id", "node").join(labels, "node", "left")
        # A text without words is a class of its own document; copies share their node.
        classes = durable(
            classes.select(
                "key", "doc_id", F.coalesce("label", "node", F.encode("key", "UTF-8")).alias("label")
            ),
            "classes",
        )
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    named_classes = classes.groupBy("label").agg(best.alias("best"), F.count("*").alias("class_size"))
    return classes.join(named_classes, "label").select(
        "key",
        "doc_id",
        F.col("best.doc_id").alias("class_id"),
        "class_size",
        (F.col("key") == F.col("best.key")).alias("kept"),
    )


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of `docs` that represent their class, one of each, with all their columns."""
    keys = (
        near_duplicates(docs, doc_id=doc_id, text=text, **options)
        .filter("kept")
        .select(F.col("key").alias("_kept_key"))
        .distinct()
    )
    value = F.coalesce(docs[text], F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        row.alias("row"),
        _key(docs[doc_id].cast("long"), value).alias("key"),
        F.xxhash64(row).alias("content"),
    )
    first = W.partitionBy("key").orderBy("content")
    return (
        rows.join(keys, F.col("key") == F.col("_kept_key"), "left_semi")
        .withColumn("place", F.row_number().over(first))
        .filter("place = 1")
        .select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
    )
