"""Language identification by rank-order profiles of n-grams.

A text is lowered and reduced to words of letters, each with a blank before and after; n-grams
of one to three characters are counted, blanks alone left out. The `profile` most frequent
n-grams of a language, counted over all training texts, form its profile. A text's own most
frequent n-grams are ranked alike; each is out of place by the difference of its two ranks, or
by `profile` if the language lacks it. The language with the smallest sum wins.

n-grams are compared by their code points, exactly. Ties in frequency go to the smaller code
points, ties in distance to the smaller language name. The score is 1 - sum / largest sum
possible. A text that is null or has no letters is `und` with score 0; so is every text when
there is nothing to learn from. Rows are judged each for itself, repeated or not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import arrow_map, slices

PROFILE = 400
UNKNOWN = "und"

_BLANK = 1  # stands for a word's border; not a letter
_BITS = 21  # of a code point
_MASK = (1 << _BITS) - 1
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        table = np.zeros(0x110000, dtype=bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _letters.append(table)
    return _letters[0]


def _grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, n = 1 to 3, as numbers, and how often each occurs.

    An n-gram is its code points in 21 bits each, the first in the highest place of three, so
    that shorter ones are prefixes of longer ones with zeros behind.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = _is_letter()[points]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # one blank between words, one at either end
    keep = is_letter.copy()
    keep[:-1] |= is_letter[1:]
    line = np.where(is_letter, points, _BLANK)[keep].astype(np.int64)
    line = np.concatenate([line if line[0] == _BLANK else np.r_[_BLANK, line], [_BLANK]])
    nxt = np.concatenate([line[1:], [0]])
    after = np.concatenate([line[2:], [0, 0]])
    after[nxt == _BLANK] = 0  # words are counted apart
    three = np.sort((line << (2 * _BITS)) | (nxt << _BITS) | after)
    made = [_counts(three, np.ones(len(three), dtype=np.int64))]
    for bits in (_BITS, 2 * _BITS):  # shorter ones, from the counts of the longer
        longer, times = made[-1]
        made.append(_counts((longer >> bits) << bits, times))
    codes = np.concatenate([made[0][0], made[1][0], made[2][0]])
    times = np.concatenate([made[0][1], made[1][1], made[2][1]])
    full = np.concatenate([np.full(len(m[0]), 3 - k) for k, m in enumerate(made)])
    # a number stands for an n-gram of its length only, and lone blanks say nothing
    length = (
        1 + ((codes >> _BITS) & _MASK > 0).astype(np.int64) + (codes & _MASK > 0).astype(np.int64)
    )
    real = (length == full) & (codes != _BLANK << (2 * _BITS))
    return codes[real], times[real]


def _counts(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of `times` by code; `codes` are sorted."""
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.add.reduceat(times, first)


def _most_frequent(codes: np.ndarray, times: np.ndarray, n: int) -> np.ndarray:
    if len(codes) > n:  # keep what reaches the n-th largest count, ties included
        least = np.partition(times, len(times) - n)[len(times) - n]
        some = times >= least
        codes, times = codes[some], times[some]
    return codes[np.lexsort((codes, -times))][:n]


def learn(
    docs: DataFrame, profile: int = PROFILE, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """Profiles (lang, gram, rank from 0) from all rows of `docs` with a text and a language."""
    rows = docs.select(docs[text].alias("text"), docs[lang].cast("string").alias("lang")).filter(
        "text IS NOT NULL AND lang IS NOT NULL"
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            by_lang: dict[str, list] = {}
            for t, name in zip(
                part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True
            ):
                by_lang.setdefault(name, []).append(_grams(t))
            for name, found in by_lang.items():
                codes = np.concatenate([c for c, _ in found])
                times = np.concatenate([n for _, n in found])
                if len(codes):
                    order = np.argsort(codes)
                    codes, times = _counts(codes[order], times[order])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(codes)), pa.array(codes), pa.array(times)],
                        ["lang", "gram", "n"],
                    )

    totals = (
        rows.mapInArrow(count, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    order = W.partitionBy("lang").orderBy(F.col("n").desc(), F.col("gram"))
    return (
        totals.withColumn("rank", F.row_number().over(order) - 1)
        .filter(F.col("rank") < profile)
        .select("lang", "gram", "rank")
    )


def predict(
    docs: DataFrame,
    profiles: DataFrame,
    profile: int = PROFILE,
    doc_id: str = "doc_id",
    text: str = "text",
    keep: dict[str, Column] | None = None,
) -> DataFrame:
    """(doc_id, `keep` columns, lang_pred, score) of every row.

    The profiles, at most `profile` rows for each language, are sent to all tasks.
    """
    rows = profiles.orderBy("lang", "rank").collect()
    names = sorted({r["lang"] for r in rows})
    grams = np.array(sorted({r["gram"] for r in rows}), dtype=np.int64)
    ranks = np.full((len(grams) + 1, len(names)), -1, dtype=np.int64)
    for r in rows:
        ranks[np.searchsorted(grams, r["gram"]), names.index(r["lang"])] = r["rank"]
    sent = docs.sparkSession.sparkContext.broadcast((names, grams, ranks))
    extra = keep or {}
    work = docs.select(
        docs[doc_id].cast("long").alias("doc_id"),
        *[c.alias(name) for name, c in extra.items()],
        F.coalesce(docs[text], F.lit("")).alias("text"),
    )

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        names, grams, ranks = sent.value
        langs, scores = [], []
        for value in batch.column("text").to_pylist():
            codes, times = _grams(value)
            if not len(codes) or not names:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            own = _most_frequent(codes, times, profile)
            at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            there = np.where((grams[at] == own)[:, None], ranks[at], -1)
            places = np.arange(len(own))[:, None]
            sums = np.where(there < 0, profile, np.abs(there - places)).sum(axis=0)
            best = int(sums.argmin())
            langs.append(names[best])
            scores.append(1.0 - float(sums[best]) / (profile * len(own)))
        kept = [batch.column(c) for c in batch.schema.names if c != "text"]
        return pa.RecordBatch.from_arrays(
            [*kept, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
            [c for c in batch.schema.names if c != "text"] + ["lang_pred", "score"],
        )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in work.schema[:-1])
    return arrow_map(work, judge, f"{kinds}, lang_pred string, score double")


def identify(
    docs: DataFrame,
    held_out: Column,
    profile: int = PROFILE,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Learn from the rows that are not held out, predict all: (doc_id, held_out, lang_pred, score)."""
    profiles = durable(learn(docs.filter(~held_out), profile, text, lang), "profiles")
    return predict(docs, profiles, profile, doc_id, text, {"held_out": held_out})
