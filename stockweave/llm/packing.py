"""Best-fit packing of documents into sequences by the sum-of-squares rule.

A document's ids end with `end_id`. Documents longer than a sequence are cut into pieces of
its capacity; their first piece may be shorter. A piece goes where it makes the sum, over all
gaps, of the squared number of open sequences with that gap smallest; a new sequence is one of
the choices, and among equals the smallest gap wins. Pieces are placed longest first; those in
sequences that are not nearly full are placed again by the same rule while that saves sequences.

The rule needs lengths only. They are dealt at random to shards of bounded size, which are
packed in tasks of their own. What ends in sequences that are not nearly full goes to another
round with fewer shards, until one shard holds it or a round no longer halves it.

Null and empty texts consist of the end id. Repeated rows are separate documents with the same
doc_id: `row` tells their pieces apart. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import arrow_map, texts
from stockweave.llm.tokens import encoder

CAPACITY = 2048
SHARD_PIECES = 100_000
NEARLY_FULL = 0.98

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    with_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: place in its document, length and checksum; `ids` (binary) if asked."""
    if capacity < 1:
        raise ValueError("a sequence holds at least one token")

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder(vocabulary).encode_batch(batch.column("text").to_pylist())
        end = np.array([end_id], dtype="<u4").tobytes()
        rows: list[tuple] = []
        for owner, raw in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
            raw += end
            n = len(raw) // 4
            bounds = [0, *range(n % capacity or capacity, n + 1, capacity)]
            for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
                part = raw[4 * a : 4 * b]
                rows.append((owner, k, a, b - a, zlib.crc32(part), part))
        columns = list(zip(*rows, strict=True))
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        keep = len(names) if with_ids else len(names) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns[:keep], kinds, strict=False)], names[:keep]
        )

    return arrow_map(texts(docs, doc_id, text), cut, _PIECE + (", ids binary" if with_ids else ""))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length, placed in the given order."""
    open_with = np.zeros(capacity + 1, dtype=np.int64)  # sequences per gap; full ones don't count
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    where = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    never = np.iinfo(np.int64).max
    for k, size in enumerate(lengths.tolist()):
        now = open_with[size:]  # gaps that are large enough, the last being a new sequence
        then = open_with[: capacity + 1 - size]  # the gaps they would leave
        change = 2 * (then - now + 1)  # (then + 1)^2 - then^2 + (now - 1)^2 - now^2
        change[now == 0] = never
        change[-1] = 2 * then[-1] + 1  # a new sequence takes no gap away
        if now[0]:
            change[0] = 1 - 2 * now[0]  # a full one leaves no gap
        gap = int(change.argmin()) + size
        if gap == capacity:
            one, made = made, made + 1
        else:
            one = by_gap[gap].pop()
            open_with[gap] -= 1
        where[k], offset[k] = one, capacity - gap
        if gap > size:
            by_gap[gap - size].append(one)
            open_with[gap - size] += 1
    return where, offset


def pack_lengths(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each length: the rule, longest first, then again.

    Sequences that are nearly full stay; what is in the others is placed anew, without their
    company, as long as that saves sequences.
    """
    where = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    todo, made = np.argsort(-lengths, kind="stable"), 0
    while len(todo):
        some, place = sum_of_squares(lengths[todo], capacity)
        filled = np.bincount(some, weights=lengths[todo])
        if len(todo) < len(lengths) and len(filled) >= len(np.unique(where[todo])):
            break  # the earlier places are as good
        loose = filled < NEARLY_FULL * capacity
        order = np.argsort(loose, kind="stable")  # those to stay are numbered first
        number = np.empty(len(filled), dtype=np.int64)
        number[order] = np.arange(len(filled))
        where[todo], offset[todo] = made + number[some], place
        made += int((~loose).sum())
        todo = todo[loose[some]]
        if loose.all():
            break
    return where, offset


def _pack_shard(capacity: int, base: int):
    def pack(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "row"], ascending=[False, True])
        sizes = shard["length"].to_numpy()
        where, offset = pack_lengths(sizes, capacity)
        filled = np.bincount(where, weights=sizes).astype(np.int64)
        return pd.DataFrame(
            {
                "row": shard["row"].to_numpy(),
                "length": sizes,
                "sequence_id": where + (base + (int(key[0]) << 28)),
                "offset": offset,
                "filled": filled[where],
            }
        )

    return pack


_PLACED = "row long, length long, sequence_id long, offset long, filled long"


def place(
    items: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """(row, sequence_id, offset) for items (row, length), each at most `capacity` long."""
    todo, placed, number = items.select("row", "length"), [], 0
    n = todo.count()
    while True:
        shards = max(1, math.ceil(n / shard_pieces))
        dealt = todo.withColumn(
            "shard", F.pmod(F.xxhash64("row", F.lit(number)), F.lit(shards)).cast("int")
        )
        packed = durable(
            dealt.groupBy("shard").applyInPandas(_pack_shard(capacity, number << 58), _PLACED),
            "packed",
        )
        loose = packed.filter(F.col("filled") < NEARLY_FULL * capacity)
        left = loose.count() if shards > 1 else 0
        if not left or left > n / 2 or number == 15:
            placed.append(packed)
            break
        placed.append(packed.filter(F.col("filled") >= NEARLY_FULL * capacity))
        todo, n, number = loose.select("row", "length"), left, number + 1
    out = placed[0]
    for more in placed[1:]:
        out = out.unionAll(more)
    return out.select("row", "sequence_id", "offset")


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = CAPACITY,
    end_id: int = 0,
    shard_pieces: int = SHARD_PIECES,
    with_ids: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Place every document of `docs`: its pieces with `sequence_id` and `offset`."""
    found = durable(
        pieces(docs, vocabulary, capacity, end_id, with_ids, doc_id, text).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    whole = F.col("length") == capacity
    placed = place(found.filter(~whole).select("row", "length"), capacity, shard_pieces)
    names = [c for c in found.columns if c != "row"]
    alone = found.filter(whole).select(
        *names, "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return (
        found.filter(~whole)
        .join(placed, "row")
        .select(*names, "row", "sequence_id", "offset")
        .unionAll(alone)
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: (sequence_id, n_tokens, ids), from `pack(..., with_ids=True)`."""

    def join(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            parts = batch.column("parts").to_pylist()
            ids = [np.frombuffer(b"".join(p["ids"] for p in ps), dtype="<u4") for ps in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("sequence_id"),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64())),
                ],
                ["sequence_id", "n_tokens", "ids"],
            )

    return (
        packed.groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .mapInArrow(join, "sequence_id long, n_tokens long, ids array<long>")
    )
