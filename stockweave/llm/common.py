"""What the text operators share: narrow inputs, bounded batches, hashes of byte spans.

Every operator selects the columns it needs under names of its own, so extra columns of its
input, whatever they are called, can't clash. Text crosses to Python in Arrow batches, which
are cut into slices of bounded bytes; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.durable import remove, scratch_path

SLICE_BYTES = 1 << 19  # of text handled at once, unless a single text is longer

# White space of the text operators: space, tab, line feed, vertical tab, form feed, return.
SPACES = (32, 9, 10, 11, 12, 13)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True

_U = np.uint64
_BASES = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93))  # any odd numbers do


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text is empty."""
    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )


class Scratch(AbstractContextManager):
    """Results written once to shared scratch space, and removed at the end of the block."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def store(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, label)
        self.paths.append(path)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self, keep: int = 0) -> None:
        """Remove all but the `keep` latest results."""
        gone = self.paths[: len(self.paths) - keep]
        self.paths = self.paths[len(gone) :]
        for path in gone:
            remove(self.spark, path)

    def __exit__(self, *_) -> None:
        self.release()


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of `batches`, as zero-copy slices with at most SLICE_BYTES of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = span_offsets(batch.column(text))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def span_offsets(column: pa.Array) -> np.ndarray:
    """Offsets of a column of text or binary values into its data buffer."""
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    raw = np.frombuffer(column.buffers()[1], dtype=np.int64 if large else np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after another, and the n + 1 borders between them."""
    offsets = span_offsets(column)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE_VALUES = [mix(np.arange(1, 257, dtype=_U) * base) for base in _BASES]
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^j and base^-j modulo 2^64 for j <= n."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        base = int(_BASES[which])
        both = []
        for factor in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, factor, dtype=_U)
            steps[0] = 1
            both.append(np.cumprod(steps))
        have = both[0], both[1]
        if size <= 4 * SLICE_BYTES:
            _POWERS[which] = have
    return have


def span_hashes(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0
) -> np.ndarray:
    """A 64-bit hash of each span of bytes. `which` (0 or 1) picks one of two functions."""
    powers, inverse = _powers(which, len(raw))
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum(_BYTE_VALUES[which][raw] * powers[: len(raw)], out=sums[1:])
    spans = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(spans + (ends - starts).astype(_U) * _U(0xA24BAED4963EE407))


def word_spans(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document number) of all words: runs without white space in one text."""
    filled = ~_IS_SPACE[raw]
    first = np.zeros(len(raw) + 1, dtype=bool)
    first[borders] = True
    before = np.zeros(len(raw), dtype=bool)
    before[1:] = filled[:-1]
    after = np.zeros(len(raw), dtype=bool)
    after[:-1] = filled[1:]
    starts = np.flatnonzero(filled & (~before | first[:-1]))
    ends = np.flatnonzero(filled & (~after | first[1:])) + 1
    return starts, ends, np.searchsorted(borders, starts, "right") - 1


def line_spans(raw: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, document number) of all lines; a text without line feeds is one line."""
    feeds = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([borders[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([feeds, borders[1:]]), kind="stable")
    owner = np.concatenate(
        [np.arange(len(borders) - 1), np.searchsorted(borders, feeds, "right") - 1]
    )
    return starts, ends, np.sort(owner, kind="stable")


def per_document(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of `values` by document number."""
    return np.bincount(owner, weights=values, minlength=n).astype(np.int64)


def as_signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


def arrow_map(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str
) -> DataFrame:
    """Apply `fn` to bounded slices of `df`, which has a text column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = fn(part)
            if made is not None:
                yield made

    return df.mapInArrow(run, schema)
