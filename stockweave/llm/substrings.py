"""Removal of repeated byte strings by suffix sorting.

A byte goes if a string of `length` bytes that covers it also starts earlier: in a document
with a smaller doc_id, or earlier in the same document. Strings never cross documents and are
judged on the input.

1. The windows of `length` bytes of a text are cut into segments: runs of windows with the same
   smallest hash among their strings of `GRAM` bytes. Equal windows have equal smallest
   hashes, so only segments whose hash occurs twice can hold repeated windows.
2. These segments, each content once with its first place, are dealt by their hash to shards.
3. A shard is suffix-sorted (`suffixsort`); neighbours with a common prefix of `length` bytes or
   more form classes of equal windows, and each class has a first place.
   A key whose contents exceed a shard (a passage that many documents share gets a content of
   its own from each document at its edges) isn't dealt: its windows are grouped by their own
   128-bit hashes, so no task holds them together.
4. The occurrences of each content are compared with these first places; what starts later is
   covered, spans are united per document, and the texts are cut.

A null text is empty. Rows with the same doc_id and text are one document and fare alike; texts
of one doc_id that differ are ordered by a hash. Null doc_ids come first. Texts shorter than
`length` stay as they are. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import arrow_map, as_signed, mix, slices, span_hashes, utf8
from stockweave.llm.suffixsort import window_classes

LENGTH = 100
GRAM = 20
SHARD_BYTES = 3 << 20

_U = np.uint64
_NONE = _U(0xFFFFFFFFFFFFFFFF)


def _gram_hashes(raw: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the `gram` bytes, 8 or more, from each position that has so many after it."""
    x = raw.astype(_U)
    for step in (1, 2, 4):  # eight bytes from each position
        x = x[:-step] | (x[step:] << _U(8 * step))
    n = len(raw) - gram + 1
    h = mix(x[:n])
    for at in range(8, gram, 8):
        h += x[min(at, gram - 8) :][:n]
        h = mix(h)
    return h


def segments(
    raw: np.ndarray, borders: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, end, document, inner) of all segments; they overlap by length - 1 bytes.

    Two windows of one segment can be equal only if `inner`: the segment goes on after a window
    that begins with the string of the smallest hash, so that the string comes again.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(raw) < length:
        return empty.astype(_U), empty, empty, empty, empty.astype(bool)
    grams = low = _gram_hashes(raw, gram)
    width, have = length - gram + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    # low[p]: the smallest hash of window p; windows that cross a border don't count
    n = len(low)
    cross = np.zeros(n + 1, dtype=np.int64)
    inner = borders[1:-1]
    np.add.at(cross, np.clip(inner - length + 1, 0, n), 1)
    np.subtract.at(cross, np.minimum(inner, n), 1)
    inside = np.cumsum(cross)[:n] == 0
    begins = np.zeros(n + 1, dtype=bool)
    begins[borders[borders <= n]] = True
    begins[1:n] |= (low[1:] != low[:-1]) | ~inside[:-1]
    begins[n] = True
    starts = np.flatnonzero(begins[:n] & inside)
    ends = np.flatnonzero((begins[1:] | np.append(~inside[1:], True)) & inside) + length
    heads = np.concatenate([[0], np.cumsum(grams[:n] == low)])
    inner = heads[ends - length] > heads[starts]
    # smallest hashes are small: spread them again
    return mix(low[starts]), starts, ends, np.searchsorted(borders, starts, "right") - 1, inner


FILTER_BITS = 27
_CHUNK_BITS = 15


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, tag, text): the order of documents, null first; the tag tells texts apart."""
    value = F.coalesce(docs[text], F.lit(""))
    return docs.select(
        F.coalesce(docs[doc_id].cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
        F.xxhash64(value).alias("tag"),
        value.alias("text"),
    )


def _repeated_keys(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Keys of two segments or more, or of one whose own windows may repeat."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        key, _, _, _, inner = segments(*utf8(batch.column("text")), length, gram)
        key, at = np.unique(key, return_inverse=True)
        times = np.bincount(at, weights=1 + inner, minlength=len(key))
        return pa.RecordBatch.from_arrays(
            [pa.array(as_signed(key)), pa.array(times.astype(np.int64))], ["key", "n"]
        )

    counts = arrow_map(rows.select("text"), count, "key long, n long")
    return counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")


def _filter_bits(keys: DataFrame) -> np.ndarray:
    """A bit for each value of the highest FILTER_BITS of `key`: set if such a key is there.

    Of fixed size whatever the input: if most bits are set, more rows than needed are looked
    at, and none is missed.
    """
    places = keys.select(
        F.shiftrightunsigned("key", 64 - FILTER_BITS).alias("place")
    ).distinct()
    chunks = places.withColumn("chunk", F.shiftright("place", _CHUNK_BITS))

    def build(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _CHUNK_BITS, dtype=np.uint8)
        bits[group.column("place").to_numpy() & ((1 << _CHUNK_BITS) - 1)] = 1
        return pa.table(
            {"chunk": pa.array([key[0].as_py()], pa.int64()), "bits": [np.packbits(bits).tobytes()]}
        )

    out = np.zeros((1 << (FILTER_BITS - _CHUNK_BITS), (1 << _CHUNK_BITS) // 8), dtype=np.uint8)
    for r in chunks.groupBy("chunk").applyInArrow(build, "chunk long, bits binary").collect():
        out[r["chunk"]] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out.reshape(-1)


def _is_set(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    place = (key >> _U(64 - FILTER_BITS)).astype(np.int64)
    return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 > 0


_OCCURRENCE = (
    "key long, a long, b long, doc long, tag long, start long, n long, inner boolean, bytes binary"
)


def _occurrences(rows: DataFrame, bits, length: int, gram: int) -> DataFrame:
    """Segments whose key may repeat; n is their number of windows, a and b their content.

    The bytes are given once for each content and slice of rows, where it comes first.
    """

    def find(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, borders = utf8(batch.column("text"))
        key, start, end, of, inner = segments(raw, borders, length, gram)
        some = _is_set(bits.value, key)
        key, start, end, of, inner = (x[some] for x in (key, start, end, of, inner))
        a, b = (as_signed(span_hashes(raw, start, end, which)) for which in (0, 1))
        doc = batch.column("doc").to_numpy()[of]
        tag = batch.column("tag").to_numpy()[of]
        local = start - borders[of]
        order = np.lexsort((local, tag, doc, b, a))
        again = np.zeros(len(order), dtype=bool)
        again[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
        content = [
            None if g else raw[s:e].tobytes()
            for g, s, e in zip(again.tolist(), start.tolist(), end.tolist(), strict=True)
        ]
        columns = [as_signed(key), a, b, doc, tag, local, end - start - length + 1]
        return pa.RecordBatch.from_arrays(
            [
                *[pa.array(c, pa.int64()) for c in columns],
                pa.array(inner),
                pa.array(content, pa.binary()),
            ],
            ["key", "a", "b", "doc", "tag", "start", "n", "inner", "bytes"],
        )

    return arrow_map(rows, find, _OCCURRENCE)


_RUNS = "array<struct<from: long, to: long, doc: long, tag: long, shift: long>>"


def _own_runs(contents: pa.Table) -> pa.RecordBatch:
    """One run for each content: all its windows come first where it comes first."""
    n = contents.num_rows
    zero = pa.array(np.zeros(n, dtype=np.int64))
    columns = [zero, *(_flat(contents, c, pa.int64()) for c in ("n", "doc", "tag", "start"))]
    runs = pa.StructArray.from_arrays(columns, ["from", "to", "doc", "tag", "shift"])
    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1), pa.int32()), runs)
    a, b = (_flat(contents, c, pa.int64()) for c in ("a", "b"))
    return pa.RecordBatch.from_arrays([a, b, lists], ["a", "b", "runs"])


def _flat(table: pa.Table, name: str, kind: pa.DataType) -> pa.Array:
    chunks = table.column(name).chunks
    return pa.concat_arrays(chunks) if chunks else pa.array([], kind)


def _sharing(contents: pa.Table, length: int) -> np.ndarray:
    """Whether a content may have a window that comes again, in it or in another content.

    Equal windows have equal smallest hashes among their strings of three fifths of `length`;
    most contents that share a short phrase share none of these.
    """
    gram = max(8, 3 * length // 5)
    keys, owners, inners, done = [], [], [], 0
    for part in slices(iter(contents.to_batches()), "bytes"):
        key, _, _, of, inner = segments(*utf8(part.column("bytes")), length, gram)
        keys.append(key)
        owners.append(of + done)
        inners.append(inner)
        done += part.num_rows
    _, at, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    found = np.zeros(contents.num_rows, dtype=bool)
    found[np.concatenate(owners)[(times[at] > 1) | np.concatenate(inners)]] = True
    return found


def _sorted_shard(length: int):
    """First places of the windows of a shard's contents, as runs of neighbouring windows.

    A shard holds all contents of its keys. A key's only content has nothing to be compared
    with, unless its own windows may be equal. Nor has one that shares no longer string.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        whole = pa.Table.from_batches(parts).combine_chunks()
        _, at, times = np.unique(
            whole.column("key").to_numpy(), return_inverse=True, return_counts=True
        )
        inner = whole.column("inner").to_numpy(zero_copy_only=False)
        alone = (times[at] == 1) & ~inner
        yield _own_runs(whole.filter(pa.array(alone)))
        whole = whole.filter(pa.array(~alone)).combine_chunks()
        if not whole.num_rows:
            return
        some = _sharing(whole, length)
        yield _own_runs(whole.filter(pa.array(~some)))
        whole = whole.filter(pa.array(some)).combine_chunks()
        if not whole.num_rows:
            return
        raw, borders = utf8(whole.column("bytes").chunk(0))
        doc, tag, start = (whole.column(c).to_numpy() for c in ("doc", "tag", "start"))
        position, number = window_classes(raw, borders, length)
        # every window's first place: its own content's, unless its class has an earlier one
        owner = np.repeat(np.arange(len(doc)), np.diff(borders))
        best = owner.copy()
        shift = start[owner].copy()  # the place is (doc, tag, shift + offset in the content)
        offset = np.arange(len(raw)) - borders[owner]
        if len(position):
            of = owner[position]
            at = start[of] + offset[position]
            order = np.lexsort((at, tag[of], doc[of], number))
            head = np.ones(len(order), dtype=bool)
            head[1:] = number[order[1:]] != number[order[:-1]]
            first = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
            best[position[order]] = of[first]
            shift[position[order]] = at[first] - offset[position[order]]
        valid = borders[1:][owner] - np.arange(len(raw)) >= length
        new = np.ones(len(raw), dtype=bool)
        new[1:] = (
            (owner[1:] != owner[:-1])
            | (doc[best[1:]] != doc[best[:-1]])
            | (tag[best[1:]] != tag[best[:-1]])
            | (shift[1:] != shift[:-1])
        )
        new &= valid
        at = np.flatnonzero(new)
        windows = np.diff(borders) - length + 1
        last = np.append(at[1:], len(raw))
        last = np.where(
            np.append(owner[at[1:]] == owner[at[:-1]], False) if len(at) else [],
            offset[np.minimum(last, len(raw) - 1)],
            windows[owner[at]],
        )
        runs = pa.StructArray.from_arrays(
            [
                pa.array(c, pa.int64())
                for c in (offset[at], last, doc[best[at]], tag[best[at]], shift[at])
            ],
            ["from", "to", "doc", "tag", "shift"],
        )
        cuts = np.searchsorted(owner[at], np.arange(len(doc) + 1))
        lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs)
        yield pa.RecordBatch.from_arrays(
            [whole.column("a").chunk(0), whole.column("b").chunk(0), lists], ["a", "b", "runs"]
        )

    return sort


_KEY_BITS = 16  # keys are first weighed together by so many of their bits


def _heavy_keys(found: DataFrame, shard_bytes: int) -> tuple[DataFrame | None, int]:
    """Keys with more than `shard_bytes` of contents, if any, and the bytes of all keys.

    A content counts once for each slice it was found in. There is at most one such key for
    every shard.
    """
    with_bytes = found.filter("bytes IS NOT NULL")
    group = F.shiftrightunsigned("key", 64 - _KEY_BITS)
    size = F.sum(F.octet_length("bytes")).alias("size")
    sizes = durable(with_bytes.groupBy(group.alias("group")).agg(size), "key-sizes")
    total, most = sizes.agg(F.sum("size"), F.max("size")).first()
    if not total or most <= shard_bytes:
        return None, total or 0
    groups = sizes.filter(F.col("size") > shard_bytes).select("group")
    keys = (
        with_bytes.withColumn("group", group)
        .join(groups, "group", "left_semi")
        .groupBy("key")
        .agg(size)
        .filter(F.col("size") > shard_bytes)
        .select("key")
    )
    keys = durable(keys, "heavy-keys")
    return (keys if keys.first() else None), total


def _contents(found: DataFrame, shards: int | None = None) -> DataFrame:
    """Each content once, with its first place; all of a key in one partition if there are shards.

    One shuffle does both then: what a light key has in all slices fits a shard.
    """
    rows = found.filter("bytes IS NOT NULL")
    return (
        (rows.repartition(shards, "key") if shards else rows)
        .groupBy("key", "a", "b")
        .agg(F.min(F.struct("doc", "tag", "start", "n", "inner", "bytes")).alias("first"))
        .select("key", "a", "b", "first.*")
    )


_WINDOW_ROWS = 1 << 16


def _window_hashes(part: pa.RecordBatch, length: int) -> tuple[np.ndarray, ...]:
    """(content number, offset, hash, second hash) of all windows of the contents."""
    raw, borders = utf8(part.column("bytes"))
    windows = np.diff(borders) - length + 1
    owner = np.repeat(np.arange(len(windows)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = borders[owner] + offset
    return owner, offset, *(span_hashes(raw, starts, starts + length, k) for k in (0, 1))


def _window_runs(contents: DataFrame, length: int) -> DataFrame:
    """(a, b, runs) as `_sorted_shard` gives, with the windows grouped by their hashes.

    All windows of a content come first where it comes first, unless an equal window has an
    earlier place. Only windows whose hash occurs twice travel.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes"):
            key, n = np.unique(_window_hashes(part, length)[2], return_counts=True)
            for at in range(0, len(key), _WINDOW_ROWS):
                end = at + _WINDOW_ROWS
                columns = [pa.array(as_signed(key[at:end])), pa.array(n[at:end])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n"])

    counts = contents.select("bytes").mapInArrow(count, "key long, n long")
    again = counts.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")
    bits = contents.sparkSession.sparkContext.broadcast(
        _filter_bits(durable(again, "window-keys"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes"):
            owner, offset, key, key2 = _window_hashes(part, length)
            wanted = np.flatnonzero(_is_set(bits.value, key))
            a, b, doc, tag, start = (
                part.column(c).to_numpy() for c in ("a", "b", "doc", "tag", "start")
            )
            for at in range(0, len(wanted), _WINDOW_ROWS):
                k = wanted[at : at + _WINDOW_ROWS]
                of = owner[k]
                columns = [as_signed(key[k]), as_signed(key2[k]), a[of], b[of], offset[k]]
                columns += [doc[of], tag[of], start[of] + offset[k]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names
                )

    names = ["key", "key2", "a", "b", "offset", "doc", "tag", "at"]
    windows = durable(
        contents.select("a", "b", "doc", "tag", "start", "bytes").mapInArrow(
            place, ", ".join(f"{n} long" for n in names)
        ),
        "windows",
    )
    here = F.struct("doc", "tag", "at")
    firsts = windows.groupBy("key", "key2").agg(F.min(here).alias("first"))

    def run(first, end, doc, tag, shift):
        parts = zip(("from", "to", "doc", "tag", "shift"), (first, end, doc, tag, shift), strict=True)
        return F.struct(*[c.cast("long").alias(n) for n, c in parts])

    own = contents.select(
        "a", "b", F.array(run(F.lit(0), *map(F.col, ("n", "doc", "tag", "start")))).alias("runs")
    )
    first = F.col("first")
    offset = F.col("offset")
    earlier = (
        windows.join(firsts, ["key", "key2"])
        .filter(here > first)
        .select(
            "a",
            "b",
            F.array(
                run(offset, offset + 1, first["doc"], first["tag"], first["at"] - offset)
            ).alias("runs"),
        )
    )
    return own.unionAll(earlier)


def repeated_spans(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc, tag, spans): bytes covered by strings that start earlier too, as [from, to)."""
    if not 8 <= gram <= length:
        raise ValueError("strings of 8 bytes or more, not longer than the windows, are hashed")
    spark = docs.sparkSession
    rows = _placed(docs, doc_id, text)
    bits = spark.sparkContext.broadcast(
        _filter_bits(durable(_repeated_keys(rows, length, gram), "keys"))
    )
    found = durable(_occurrences(rows, bits, length, gram), "occurrences")
    heavy, total = _heavy_keys(found, shard_bytes)
    light = found if heavy is None else found.join(F.broadcast(heavy), "key", "left_anti")
    contents = _contents(light, max(1, -(-total // shard_bytes)))
    runs = durable(
        contents.mapInArrow(_sorted_shard(length), f"a long, b long, runs {_RUNS}"), "runs"
    )
    if heavy is not None:
        shared = found.join(F.broadcast(heavy), "key", "left_semi")
        more = _window_runs(durable(_contents(shared), "heavy"), length)
        runs = runs.unionAll(durable(more, "window-runs"))
    place = F.struct("doc", "tag", "start")
    run = F.col("run")
    return (
        found.select("a", "b", "doc", "tag", "start")
        .join(runs, ["a", "b"])
        .withColumn("run", F.explode("runs"))
        .filter(place > F.struct(run["doc"], run["tag"], run["shift"]))
        .select(
            "doc",
            "tag",
            F.struct(
                (F.col("start") + run["from"]).alias("from"),
                (F.col("start") + run["to"] + (length - 1)).alias("to"),
            ).alias("span"),
        )
        .groupBy("doc", "tag")
        .agg(F.collect_set("span").alias("spans"))
    )


def _cut(with_text: bool):
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, borders = utf8(batch.column("text"))
        spans = batch.column("spans")
        rows: list[tuple] = []
        for k, some in enumerate(spans.to_pylist()):
            value = raw[borders[k] : borders[k + 1]]
            gone = np.zeros(len(value) + 1, dtype=np.int64)
            for span in some or ():
                gone[span["from"]] += 1
                gone[span["to"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            kept = value[~gone].tobytes() if some else value.tobytes()
            runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
            row = (len(value), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept) if with_text else row)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                *[pa.array(c, kind) for c, kind in zip(columns, kinds, strict=False)],
            ],
            ["doc_id", *names[: len(columns)]],
        )

    return cut


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
    with_text: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; `kept` bytes if asked."""
    spark = docs.sparkSession
    spans = durable(
        repeated_spans(docs, length, gram, shard_bytes, doc_id, text).withColumn(
            "key", F.xxhash64("doc", "tag")
        ),
        "spans",
    )
    bits = spark.sparkContext.broadcast(_filter_bits(spans.select("key")))
    rows = _placed(docs, doc_id, text).withColumn("key", F.xxhash64("doc", "tag"))
    # only texts that may have spans travel to them
    touched = rows.mapInArrow(
        _chosen(bits, True), "doc long, tag long, text string, key long"
    ).join(spans.drop("key"), ["doc", "tag"], "left")
    others = rows.mapInArrow(_chosen(bits, False), "doc long, tag long, text string, key long")
    null = F.lit(-(1 << 63)).cast("long")
    both = touched.select("doc", "text", "spans").unionAll(
        others.select("doc", "text", F.lit(None).cast(spans.schema["spans"].dataType))
    )
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return arrow_map(
        both.select(F.nullif("doc", null).alias("doc_id"), "text", "spans"),
        _cut(with_text),
        schema + (", kept binary" if with_text else ""),
    )


def _chosen(bits, wanted: bool):
    """The rows whose key is in the filter, or those whose key isn't."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(_U)
            yield batch.filter(pa.array(_is_set(bits.value, key) == wanted))

    return choose
