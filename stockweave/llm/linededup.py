"""Line dedup by overlapping windows of three lines.

The lines of a text that hold a word are numbered; every three in a row form a window, hashed
to 128 bits. A window that occurs at more than one place is kept where it comes first (smallest
doc_id, then smallest line); at its later places the lines it covers, with blank lines between
them, go. Overlapping windows merge. Texts with fewer than three lines have no window and stay
as they are; a null text stays null.

Rows with the same doc_id and text count as one place, so such rows are treated alike and none
loses lines to its twin. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import arrow_map, as_signed, line_spans, mix, span_hashes, utf8, word_spans

LINES = 3

_U = np.uint64


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, row_key, text): the key tells texts of one doc_id apart."""
    value = docs[text]
    return docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        F.xxhash64(docs[doc_id], value).alias("row_key"),
        F.coalesce(value, F.lit("")).alias("text"),
    )


def _windows(lines: int):
    def windows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        raw, borders = utf8(batch.column("text"))
        a, b, of = line_spans(raw, borders)
        number = np.arange(len(a)) - np.searchsorted(of, of)  # of the line in its text
        words = word_spans(raw, borders)[0]
        filled = np.searchsorted(words, b) > np.searchsorted(words, a)
        a, b, of, number = a[filled], b[filled], of[filled], number[filled]
        if len(a) < lines:
            return None
        m = len(a) - lines + 1
        keep = of[:m] == of[lines - 1 :]
        hashes = []
        for which in (0, 1):
            one = span_hashes(raw, a, b, which)
            window = np.zeros(m, dtype=_U)
            for k in range(lines):
                window = mix(window + one[k : k + m] + _U(k + 1))
            hashes.append(as_signed(window[keep]))
        take = pa.array(of[:m][keep])
        return pa.RecordBatch.from_arrays(
            [
                *[pa.array(h) for h in hashes],
                batch.column("doc_id").take(take),
                batch.column("row_key").take(take),
                pa.array(number[:m][keep], pa.int32()),
                pa.array(number[lines - 1 :][keep], pa.int32()),
            ],
            ["a", "b", "doc_id", "row_key", "line", "last"],
        )

    return windows


def repeated_spans(
    docs: DataFrame, lines: int = LINES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, row_key, spans): later occurrences, as first and last line numbers from 0."""
    windows = durable(
        arrow_map(
            _keyed(docs, doc_id, text),
            _windows(lines),
            "a long, b long, doc_id long, row_key long, line int, last int",
        ),
        "windows",
    )
    # One row per task and window reaches the shuffle, however often a window occurs.
    repeated = (
        windows.groupBy("a", "b")
        .agg(F.min(F.struct("doc_id", "line")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    later = windows.join(repeated, ["a", "b"]).filter(
        F.struct("doc_id", "line") > F.col("first")
    )
    return later.groupBy("doc_id", "row_key").agg(
        F.collect_set(F.struct("line", "last")).alias("spans")
    )


def _strip(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Take the lines of `spans` out of `text`."""
    values = batch.column("text")
    spans = batch.column("spans")
    clean, removed = [], np.zeros(batch.num_rows, dtype=np.int64)
    for k, (value, some) in enumerate(zip(values.to_pylist(), spans.to_pylist(), strict=True)):
        if some:
            rows = value.split("\n")
            gone = np.zeros(len(rows) + 1, dtype=np.int64)
            for s in some:
                gone[s["line"]] += 1
                gone[s["last"] + 1] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            removed[k] = gone.sum()
            value = "\n".join(r for r, g in zip(rows, gone.tolist(), strict=True) if not g)
        clean.append(value)
    kept = [c for c in batch.schema.names if c not in ("text", "spans")]
    return pa.RecordBatch.from_arrays(
        [*[batch.column(c) for c in kept], pa.array(clean, pa.string()), pa.array(removed)],
        [*kept, "clean_text", "n_removed"],
    )


def dedup_lines(
    docs: DataFrame, lines: int = LINES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of `docs` with the text cleaned, and `n_removed` lines.

    The result has the columns of `docs`, then n_removed (long); a column of that name in
    `docs` is replaced.
    """
    names = [c for c in docs.columns if c != "n_removed"]
    spans = repeated_spans(docs, lines, doc_id, text)
    rest = [c for c in names if c != text]
    work = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row"),
        docs[text].alias("text"),
        docs[doc_id].cast("long").alias("doc_id"),
        F.xxhash64(docs[doc_id], docs[text]).alias("row_key"),
    )
    joined = work.join(spans, ["doc_id", "row_key"], "left").select("row", "text", "spans")
    kind = joined.schema["row"].dataType.simpleString()
    out = arrow_map(joined, _strip, f"row {kind}, clean_text string, n_removed long")
    return out.select(
        *[
            (F.col("clean_text") if c == text else F.col("row").getField(c)).alias(c)
            for c in names
        ],
        "n_removed",
    )


def clean_documents(
    docs: DataFrame,
    lines: int = LINES,
    doc_id: str = "doc_id",
    text: str = "text",
    n_chars: str = "n_chars",
) -> DataFrame:
    """The rows of `docs` with the text cleaned and, if there is such a column, its length.

    Rows that lost every line with a word are gone.
    """
    out = dedup_lines(docs, lines, doc_id, text)
    out = out.filter((F.col("n_removed") == 0) | F.col(text).rlike(r"[^\x20\x09-\x0D]"))
    if n_chars in docs.columns and n_chars != text:
        kind = docs.schema[n_chars].dataType
        changed = F.when(F.col("n_removed") > 0, F.length(F.col(text)).cast(kind))
        out = out.withColumn(n_chars, changed.otherwise(F.col(n_chars)))
    return out.select(*docs.columns)
