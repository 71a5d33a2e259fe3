"""Token ids as compressed files with a shared dictionary.

`write` encodes every text, appends an end id, and stores the documents in ascending doc_id
order. A block is one self-contained binary value of a Parquet file:

    magic "TIB1" | u32 documents | 32 bytes SHA-256 of the dictionary
    | (documents + 1) x u64 offsets of the frames | (documents) x u32 tokens | frames

(little-endian). A frame is one document: its ids as unsigned 16-bit numbers if the vocabulary
allows, else 32-bit, compressed by zstandard with the dictionary, so a document is read by its
offsets alone. Spark's writer makes the files, so a lost task leaves nothing half-written.

The dictionary is trained on a sample of documents: the `SAMPLE_DOCUMENTS` smallest hashes of
doc_id and text, each cut into chunks, up to `SAMPLE_BYTES`. It affects sizes only, never contents.

A null text is empty and consists of the end id. Rows that repeat a doc_id stay next to each
other, ordered by the hash of their text. Null doc_ids come first. An empty table gives files
without blocks.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.durable import scratch_path
from stockweave.llm.common import slices, texts
from stockweave.llm.tokens import encoder

MAGIC = b"TIB1"
DICTIONARY_BYTES = 64 << 10
SAMPLE_DOCUMENTS = 2000
SAMPLE_BYTES = 4 << 20
BLOCK_DOCUMENTS = 2000
BLOCK_BYTES = 4 << 20
LEVEL = 1
TEXT_BYTES_PER_PART = 32 << 20
PARTS_PER_GROUP = 4096

_BLOCK = (
    "part int, block int, documents int, tokens long, doc_ids array<long>, payload binary"
)


def _narrow(raw: bytes, wide: bool) -> bytes:
    return raw if wide else np.frombuffer(raw, dtype="<u4").astype("<u2").tobytes()


def train_dictionary(arrays: Iterator[bytes]) -> bytes:
    """A zstandard dictionary for serialized id arrays; empty if there is too little to learn."""
    chunks, total = [], 0
    for raw in arrays:
        for at in range(0, len(raw), 4096):
            chunks.append(raw[at : at + 4096])
            total += len(chunks[-1])
        if total >= SAMPLE_BYTES:
            break
    size = min(DICTIONARY_BYTES, total // 10)
    if size < 1024 or len(chunks) < 16:
        return b""
    return zstandard.train_dictionary(size, chunks).as_bytes()


def pack_block(frames: list[bytes], counts: list[int], dictionary: bytes) -> bytes:
    offsets = np.zeros(len(frames) + 1, dtype="<u8")
    offsets[1:] = np.cumsum([len(f) for f in frames])
    return b"".join(
        [
            MAGIC,
            struct.pack("<I", len(frames)),
            hashlib.sha256(dictionary).digest(),
            offsets.tobytes(),
            np.array(counts, dtype="<u4").tobytes(),
            *frames,
        ]
    )


class Block:
    """Reads single documents of a block."""

    def __init__(self, payload: bytes, dictionary: bytes, wide: bool):
        if payload[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        if payload[8:40] != hashlib.sha256(dictionary).digest():
            raise ValueError("written with another dictionary")
        (self.n,) = struct.unpack_from("<I", payload, 4)
        self.offsets = np.frombuffer(payload, "<u8", self.n + 1, 40).astype(np.int64)
        at = 40 + 8 * (self.n + 1)
        self.counts = np.frombuffer(payload, "<u4", self.n, at)
        self.frames = memoryview(payload)[at + 4 * self.n :]
        self.kind = "<u4" if wide else "<u2"
        self.reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def document(self, i: int) -> np.ndarray:
        frame = self.frames[self.offsets[i] : self.offsets[i + 1]]
        return np.frombuffer(self.reader.decompress(frame), dtype=self.kind)


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write `docs` to `path`/blocks, and the dictionary to `path`/dictionary."""
    spark = docs.sparkSession
    rows = texts(docs, doc_id, text)
    wide = encoder(vocabulary).tokenizer.get_vocab_size() > 65536 or end_id > 65535
    end = np.array([end_id], dtype="<u4").tobytes()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = (
            _narrow(encoder(vocabulary).encode(text) + end, wide)
            for batch in slices(batches)
            for text in batch.column("text").to_pylist()
        )
        made = pa.array([train_dictionary(arrays)], pa.binary())
        yield pa.RecordBatch.from_arrays([made, pa.array([wide])], ["dictionary", "wide"])

    # hashes are ranked first, so that only texts of the sample move
    hashed = rows.withColumn("place", F.xxhash64("doc_id", "text"))
    last = hashed.select("place").orderBy("place").limit(SAMPLE_DOCUMENTS).agg(F.max("place"))
    cut = last.first()[0]
    sample = hashed.filter(F.col("place") <= F.lit(cut)).select("text").limit(SAMPLE_DOCUMENTS)
    learned = sample.repartition(1).mapInArrow(learn, "dictionary binary, wide boolean")
    if cut is None:  # no rows
        learned = spark.createDataFrame([(bytearray(), wide)], "dictionary binary, wide boolean")
    learned.write.parquet(f"{path}/dictionary")
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first()["dictionary"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary))
        part, number, ids, frames, counts, size = -1, 0, [], [], [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()),
                    "block": pa.array([number], pa.int32()),
                    "documents": pa.array([len(ids)], pa.int32()),
                    "tokens": pa.array([sum(counts)], pa.int64()),
                    "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                    "payload": pa.array([pack_block(frames, counts, dictionary)], pa.binary()),
                }
            )

        for batch in batches:
            part = batch.column("part")[0].as_py()
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                raws = encoder(vocabulary).encode_batch(some.column("text").to_pylist())
                for name, raw in zip(some.column("doc_id").to_pylist(), raws, strict=True):
                    raw += end
                    frames.append(press.compress(_narrow(raw, wide)))
                    ids.append(name)
                    counts.append(len(raw) // 4)
                    size += len(frames[-1])
                    if len(ids) >= BLOCK_DOCUMENTS or size >= BLOCK_BYTES:
                        yield block()
                        number, ids, frames, counts, size = number + 1, [], [], [], 0
        if ids:
            yield block()

    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // TEXT_BYTES_PER_PART), spark.sparkContext.defaultParallelism)
    ordered = (
        rows.repartitionByRange(parts, "doc_id")
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    ordered.mapInArrow(blocks, _BLOCK).write.parquet(f"{path}/blocks")


def _before(size: str, window) -> Column:
    """The sum of `size` over the rows before this one."""
    rows = window.rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(size).over(rows), F.lit(0))


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; `ids` if asked."""
    stored = spark.read.parquet(f"{path}/dictionary").first()
    dictionary, wide = bytes(stored["dictionary"]), stored["wide"]
    blocks = spark.read.schema(_BLOCK).parquet(f"{path}/blocks")
    # Starts are sums of what is before in the group of parts, in the part, and in the block. Only
    # the last window is in one task, with a row for every PARTS_PER_GROUP parts.
    sizes = blocks.select("part", "block", "tokens")
    group = F.floor(F.col("part") / PARTS_PER_GROUP).alias("of")
    parts = sizes.groupBy("part").agg(F.sum("tokens").alias("n")).select("part", group, "n")
    groups = parts.groupBy("of").agg(F.sum("n").alias("n"))
    groups = groups.select("of", _before("n", W.orderBy("of")).alias("in_all"))
    parts = parts.select("part", "of", _before("n", W.partitionBy("of").orderBy("part")).alias("in_group"))
    starts = (
        sizes.select(
            "part", "block", _before("tokens", W.partitionBy("part").orderBy("block")).alias("in_part")
        )
        .join(parts, "part")
        .join(groups, "of")
        .select(
            "part", "block", (F.col("in_all") + F.col("in_group") + F.col("in_part")).alias("first")
        )
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.column("payload")[i].as_py(), dictionary, wide)
                start = batch.column("first")[i].as_py()
                counts = block.counts.astype(np.int64)
                ids = [block.document(k).astype("<u4") for k in range(block.n)]
                columns = {
                    "doc_id": batch.column("doc_ids")[i].values,
                    "start": pa.array(start + np.cumsum(counts) - counts),
                    "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    return (
        blocks.select("part", "block", "doc_ids", "payload")
        .join(starts, ["part", "block"])
        .select("first", "doc_ids", "payload")
        .mapInArrow(unpack, schema + (", ids array<long>" if with_ids else ""))
    )


def token_table(
    docs: DataFrame, vocabulary: str, end_id: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Write `docs` to shared scratch space and read the files back."""
    spark = docs.sparkSession
    path = scratch_path(spark, "token-files")
    write(docs, path, vocabulary, end_id, doc_id, text)
    return read(spark, path)
