"""Quality rules: counts per document, and repetition found by suffix arrays.

Words are runs without white space (space, tab, line feed, vertical tab, form feed, return).
For each text a suffix array over its words is built by prefix doubling, with the lengths of
the common prefixes of neighbours. A word's longest repeat is the value of the deepest interval
of common prefixes that holds its suffix; these maximal repeated strings, of `min_words` words
or more, are laid over the text and their spans united. A text is rejected when the spans cover
more than `max_covered` of its words or when one repeat is longer than `max_longest` words.

A null or empty text has no words, so the base rules reject it. Repeated rows are judged each
for itself; ties don't arise. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import (
    arrow_map,
    line_spans,
    mix,
    per_document,
    span_hashes,
    texts,
    utf8,
    word_spans,
)

SYMBOLS = "#*$%&|<>"
MIN_REPEAT_WORDS = 8
MAX_COVERED = 0.3
MAX_LONGEST = 100
MIN_WORDS = 50
WINDOW = 3

_U = np.uint64


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, common prefix of each suffix with the one before it).

    No two suffixes may be equal as far as the shorter one goes and then both end: the caller
    gives every text symbols of its own, so that nothing matches beyond the end of a text.
    The order of symbols is that of their numbers.
    """
    n = len(symbols)
    order = np.argsort(symbols)
    head = np.ones(n, dtype=bool)
    head[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n + 1, dtype=np.int64)  # of a suffix: the first place of its group
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank[n] = -1
    ranks, step = [rank], 1
    while True:
        alone = head.copy()
        alone[:-1] &= head[1:]
        slots = np.flatnonzero(~alone)
        if not len(slots):
            break
        some = order[slots]
        nxt = rank[np.minimum(some + step, n)]
        key = rank[some] * (n + 1) + nxt + 1
        by_key = np.argsort(key)
        key = key[by_key]
        order[slots] = some[by_key]
        new = np.ones(len(slots), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        head[slots] = new
        rank = rank.copy()
        rank[order[slots]] = np.maximum.accumulate(np.where(new, slots, 0))
        ranks.append(rank)
        step *= 2
    common = np.zeros(n, dtype=np.int64)
    same = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]]) + 1
    left, right = order[same - 1], order[same]
    length = np.zeros(len(same), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        # equal ranks of round k: the next 2^k symbols are equal
        a, b = np.minimum(left + length, n), np.minimum(right + length, n)
        length += (ranks[k][a] == ranks[k][b]).astype(np.int64) << k
    common[same] = length
    return order, common


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest string from there that occurs elsewhere."""
    order, common = suffix_array(symbols)
    deepest = common.copy()
    deepest[:-1] = np.maximum(deepest[:-1], common[1:])
    out = np.empty(len(symbols), dtype=np.int64)
    out[order] = deepest
    return out


def covered(lengths: np.ndarray) -> np.ndarray:
    """The positions i .. i + lengths[i] - 1 of all i, united."""
    n = len(lengths)
    change = np.zeros(n + 1, dtype=np.int64)
    starts = np.flatnonzero(lengths)
    change[: n] += (lengths > 0).astype(np.int64)
    np.subtract.at(change, starts + lengths[starts], 1)
    return np.cumsum(change)[:n] > 0


def runs(mask: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) of the runs of a mask; runs end where the owner changes."""
    edge = np.ones(len(mask), dtype=bool)
    edge[1:] = owner[1:] != owner[:-1]
    before = np.zeros(len(mask), dtype=bool)
    before[1:] = mask[:-1]
    first = np.flatnonzero(mask & (~before | edge))
    after = np.zeros(len(mask), dtype=bool)
    after[:-1] = mask[1:] & ~edge[1:]
    return first, np.flatnonzero(mask & ~after) + 1


_COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "repeat_covered_words",
    "longest_repeat_words",
)


def _measure(min_words: int, with_spans: bool):
    is_symbol = np.zeros(256, dtype=bool)
    is_symbol[[ord(c) for c in SYMBOLS]] = True

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, borders = utf8(batch.column("text"))
        n = len(borders) - 1
        starts, ends, owner = word_spans(raw, borders)
        points = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        symbols = np.concatenate([[0], np.cumsum(is_symbol[raw])])
        words = mix(span_hashes(raw, starts, ends) + mix(owner.astype(_U)))  # of its text only
        repeat = longest_repeats(words) if len(words) else np.zeros(0, dtype=np.int64)
        in_windows = covered(np.where(repeat >= WINDOW, WINDOW, 0))
        long = np.where(repeat >= min_words, repeat, 0)
        in_repeats = covered(long)
        longest = np.zeros(n, dtype=np.int64)
        np.maximum.at(longest, owner, long)

        a, b, of = line_spans(raw, borders)
        filled = np.searchsorted(starts, b) > np.searchsorted(starts, a)
        a, b, of = a[filled], b[filled], of[filled]
        _, first = np.unique(mix(span_hashes(raw, a, b) + mix(of.astype(_U))), return_index=True)
        lines = per_document(np.ones(len(of)), of, n)
        columns = {
            "n_words": per_document(np.ones(len(owner)), owner, n),
            "word_chars": per_document(points[ends] - points[starts], owner, n),
            "n_symbols": np.diff(symbols[borders]),
            "n_dup_lines": lines - per_document(np.ones(len(first)), of[first], n),
            "n_repeat_words": per_document(in_windows, owner, n),
            "repeat_covered_words": per_document(in_repeats, owner, n),
            "longest_repeat_words": longest,
        }
        arrays = [pa.array(columns[c], pa.int64()) for c in _COUNTS]
        names = list(_COUNTS)
        if with_spans:
            first, last = runs(in_repeats, owner)
            at = np.concatenate([[0], np.cumsum(np.bincount(owner[first], minlength=n))])
            origin = borders[owner[first]]
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array(starts[first] - origin, pa.int64()),
                    pa.array(ends[last - 1] - origin, pa.int64()),
                ],
                ["start", "end"],
            )
            arrays.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pairs))
            names.append("repeat_spans")
        kept = [c for c in batch.schema.names if c != "text"]
        return pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept], *arrays], [*kept, *names]
        )

    return measure


def rules(
    docs: DataFrame,
    min_words: int = MIN_REPEAT_WORDS,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    with_spans: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Counts, `base_failed` and `kept` of every row.

    `with_spans` adds the united spans of the repeats as (start, end) in UTF-8 bytes.
    """
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTS)
    if with_spans:
        schema += ", repeat_spans array<struct<start: long, end: long>>"
    return judged(
        arrow_map(texts(docs, doc_id, text), _measure(min_words, with_spans), schema),
        max_covered,
        max_longest,
    )


def judged(counts: DataFrame, max_covered: float, max_longest: int) -> DataFrame:
    words, again = F.col("n_words"), F.col("n_repeat_words")
    failed = (words < MIN_WORDS) | (100 * again > 50 * words)
    repetitive = (F.col("repeat_covered_words") > max_covered * words) | (
        F.col("longest_repeat_words") > max_longest
    )
    return counts.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)


def filter_documents(
    docs: DataFrame,
    min_words: int = MIN_REPEAT_WORDS,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    text: str = "text",
) -> DataFrame:
    """The rows of `docs` that pass, with all their columns. One pass, no shuffle."""
    names = docs.columns
    work = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )
    # The row travels beside the text, so its own columns may have any names.
    row = work.schema["row"].dataType.simpleString()
    schema = f"row {row}, " + ", ".join(f"{c} long" for c in _COUNTS)
    counts = arrow_map(work, _measure(min_words, False), schema)
    kept = judged(counts, max_covered, max_longest).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in names])
