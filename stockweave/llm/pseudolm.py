"""Masked pseudo-likelihood by a bidirectional window network, trained in numpy.

Words (runs without white space, lowered, known by 64 bits) are counted exactly over all
documents. The most frequent ones, KNOWN at most, are outputs of the network; the others share
BUCKETS outputs by their hash, and inside a bucket a word has its share of the bucket's count
(UNSEEN occurrences are set aside for words that were never counted). The network sees two words
on either side of a masked one: the INPUTS most frequent outputs have vectors of their own, the
others that of their class, and the border of a text has one. Through one hidden layer it
predicts the output in two levels, both from the hidden layer: a softmax over at most CLASSES
classes, and a binary tree inside the class with a vector per fork. So
log P(word | both sides) = log P(class | h) + sum of log P(fork | h) + log P(word | bucket), the
last for words of a bucket only, and a document's score is the sum over all its words. Before
training, all of it equals the exact word frequencies.

The table of counts stays in Spark and is joined to the documents' words: it grows with the
input and no task or driver holds it. Training visits every document once: in each of ROUNDS
rounds every task starts from the same parameters and passes over its documents of that round;
the parameters it ends with are averaged, weighted by words, FAN_IN tasks at a time.

A text without words, null or empty, has score 0 and no mean. Rows are scored each for itself,
repeated ones alike. Parameters, and so scores, depend slightly on how the input is split into
tasks; with given parameters a row's score doesn't. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.llm.common import (
    Scratch,
    arrow_map,
    as_signed,
    per_document,
    slices,
    span_hashes,
    texts,
    utf8,
    word_spans,
)

KNOWN = 40960
BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
UNSEEN = 1 / 16
CLASSES = 64
INPUTS = 4096
SIDE = 2
WIDTH = 8
HIDDEN = 8
ROUNDS = 2
BATCH = 2048
RATE = 0.5
FORK_RATE = 0.25
FORK_LEAST = 8  # a fork that fewer words of a batch pass moves as if so many did
FAN_IN = 8

_COUNTED = 1 << 21  # words counted in a task before their counts move on
_OCTAVE = 16  # bins of counts in a factor of two
_U = np.uint64


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(64 bits, text number) of all words of a column of texts, in order."""
    raw, borders = utf8(pc.utf8_lower(column))
    starts, ends, owner = word_spans(raw, borders)
    return span_hashes(raw, starts, ends), owner


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n): how often each word occurs in all texts, exactly."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            words, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(as_signed(words)), pa.array(n, pa.int64())], ["word", "n"]
            )

        for part in slices(batches):
            held.append(word_hashes(part.column("text"))[0])
            if sum(map(len, held)) >= _COUNTED:
                yield counted()
        if held:
            yield counted()

    return (
        rows.select("text")
        .mapInArrow(count, "word long, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def split_counts(counts: DataFrame, known: int = KNOWN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of the most frequent words, at most `known`, their counts, and the summed
    counts of the other words by bucket.

    The border is a count, found by a histogram of bins of counts, so that equally frequent
    words fare alike, and neither a sort of all words nor a task with many of them is needed.
    """
    bin_of = F.floor(F.log2("n") * _OCTAVE)
    bins = counts.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("words")).collect()
    border, room = math.inf, known
    for r in sorted(bins, key=lambda r: -r["bin"]):  # one row per bin: 1,024 at most
        if r["words"] > room:
            break
        border, room = r["bin"], room - r["words"]
    frequent = bin_of >= F.lit(float(border))
    top = counts.filter(frequent).toPandas()  # `known` rows at most
    words = top["word"].to_numpy(dtype=np.int64).view(_U)
    order = np.argsort(words)
    bucket = F.shiftrightunsigned("word", 64 - BUCKET_BITS)
    sums = counts.filter(~frequent).groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n"))
    totals = np.zeros(BUCKETS, dtype=np.int64)
    for r in sums.collect():  # BUCKETS rows at most
        totals[r["bucket"]] = r["n"]
    return words[order], top["n"].to_numpy(dtype=np.int64)[order], totals


class Vocabulary:
    """Outputs of the network, their classes and paths, and the input numbers of words.

    Outputs are numbered: known words by hash, then buckets. An output's path has forks (numbers
    over all classes) and sides (1 or -1); every fork's `lean` is the logarithm of the ratio of
    the counts on its sides.
    """

    def __init__(self, words: np.ndarray, counts: np.ndarray, totals: np.ndarray):
        self.words = words
        self.log_total = np.log(totals + UNSEEN)
        mass = np.concatenate([counts.astype(np.float64), totals + UNSEEN])
        order = np.argsort(-mass, kind="stable")
        before = np.cumsum(mass[order]) - mass[order]
        band = np.minimum(before / mass.sum() * CLASSES, CLASSES - 1).astype(np.int64)
        first, band = np.unique(band, return_index=True, return_inverse=True)[1:]
        self.class_of = np.empty(len(mass), dtype=np.int64)
        self.class_of[order] = band
        self.classes = len(first)
        self.log_mass = np.log(np.bincount(self.class_of, weights=mass) / mass.sum())
        self._grow(order, mass, np.append(first, len(mass)))
        frequent = order[:INPUTS]
        self.input_of = (len(frequent) + self.class_of).astype(np.uint16)
        self.input_of[frequent] = np.arange(len(frequent))
        self.border = len(frequent) + self.classes
        self.inputs = self.border + 1

    def _grow(self, order: np.ndarray, mass: np.ndarray, cuts: np.ndarray) -> None:
        """The trees: outputs by falling mass, halved by mass again and again."""
        sums = np.concatenate([[0.0], np.cumsum(mass[order])])
        forks: list[tuple[int, ...]] = [()] * len(mass)
        sides: list[tuple[int, ...]] = [()] * len(mass)
        lean: list[float] = []
        todo = [(a, b, (), ()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        while todo:
            a, b, path, turns = todo.pop()
            if b - a == 1:
                forks[order[a]], sides[order[a]] = path, turns
                continue
            half = int(np.searchsorted(sums[a : b + 1], (sums[a] + sums[b]) / 2)) + a
            middle = min(max(half, a + 1), b - 1)
            lean.append(math.log((sums[middle] - sums[a]) / (sums[b] - sums[middle])))
            path = (*path, len(lean) - 1)
            todo.append((a, middle, path, (*turns, 1)))
            todo.append((middle, b, path, (*turns, -1)))
        self.lean = np.array(lean, dtype=np.float32)
        self.depth = np.array([len(p) for p in forks], dtype=np.int64)
        self.path_start = np.cumsum(self.depth) - self.depth
        self.forks = np.array([f for p in forks for f in p], dtype=np.uint16)
        self.sides = np.array([s for p in sides for s in p], dtype=np.float32)

    def outputs(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(output, whether it is a bucket) of hashes of words."""
        out = len(self.words) + (words >> _U(64 - BUCKET_BITS)).astype(np.int64)
        rare = np.ones(len(words), dtype=bool)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            rare = self.words[at] != words
            out = np.where(rare, out, at)
        return out, rare

    def windows(self, outputs: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Input numbers of the words around each word; beyond its text, the border's."""
        n = len(outputs)
        inputs = self.input_of[outputs]
        out = np.full((n, 2 * SIDE), self.border, dtype=np.uint16)
        for column, shift in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
            a, b = max(0, -shift), n - max(0, shift)
            if b > a:
                same = owner[a + shift : b + shift] == owner[a:b]
                out[a:b, column] = np.where(same, inputs[a + shift : b + shift], self.border)
        return out

    def paths(self, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in `outputs`, fork, side) along the paths of all outputs, in order."""
        depth = self.depth[outputs]
        who = np.repeat(np.arange(len(outputs)), depth)
        at = np.repeat(self.path_start[outputs] - (np.cumsum(depth) - depth), depth)
        at += np.arange(len(who))
        return who, self.forks[at], self.sides[at]


def first_parameters(vocabulary: Vocabulary, seed: int = 7) -> list[np.ndarray]:
    """Vectors of inputs, hidden layer, its shifts, classes, their shifts, forks, their shifts.

    Classes and forks start with the counts alone."""
    rng = np.random.default_rng(seed)

    def draw(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    wide = 2 * SIDE * WIDTH
    return [
        draw(vocabulary.inputs, WIDTH, scale=0.3),
        draw(wide, HIDDEN, scale=1 / math.sqrt(wide)),
        np.zeros(HIDDEN, np.float32),
        np.zeros((HIDDEN, vocabulary.classes), np.float32),
        vocabulary.log_mass.astype(np.float32),
        np.zeros((len(vocabulary.lean), HIDDEN), np.float32),
        vocabulary.lean.copy(),
    ]


def forward(p: list[np.ndarray], windows: np.ndarray) -> tuple[np.ndarray, ...]:
    """(inputs, hidden layer, probabilities of the classes)."""
    vectors = p[0].take(windows, axis=0).reshape(len(windows), -1)
    hidden = np.tanh(vectors @ p[1] + p[2])
    scores = hidden @ p[3] + p[4]
    np.clip(scores, -60, 60, out=scores)  # no overflow; untrained, they are logarithms of shares
    np.exp(scores, out=scores)
    scores /= (scores @ np.ones(scores.shape[1], scores.dtype))[:, None]
    return vectors, hidden, scores


def turns(
    p: list[np.ndarray], sides: np.ndarray, forks: np.ndarray, hidden: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of forks, exp(-logit) of every turn); `hidden` has a column per turn."""
    vectors = np.ascontiguousarray(p[5].take(forks, axis=0).T)
    logits = (vectors * hidden).sum(axis=0) + p[6].take(forks)
    return vectors, np.exp(np.minimum(-sides * logits, np.float32(60)))


def log_outputs(
    p: list[np.ndarray], vocabulary: Vocabulary, windows: np.ndarray, outputs: np.ndarray
) -> np.ndarray:
    """log P(output | window)."""
    _, hidden, shares = forward(p, windows)
    who, forks, sides = vocabulary.paths(outputs)
    inside = np.log1p(turns(p, sides, forks, hidden.T.take(who, axis=1))[1])
    mine = shares[np.arange(len(outputs)), vocabulary.class_of[outputs]]
    return np.log(np.maximum(mine, np.float32(1e-30))) - np.bincount(
        who, weights=inside, minlength=len(outputs)
    )


def _starts(sorted_: np.ndarray) -> np.ndarray:
    """Where the runs of equal values start."""
    return np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))


def train_batch(
    p: list[np.ndarray],
    vocabulary: Vocabulary,
    windows: np.ndarray,
    outputs: np.ndarray,
    rate: float,
    fork_rate: float,
) -> None:
    """One step down the gradient of the mean loss, in place. A fork's step is by the mean over
    the words that pass it, not over the batch: else rare words' forks would hardly move."""
    vectors, hidden, slope = forward(p, windows)
    who, forks, sides = vocabulary.paths(outputs)
    n = len(outputs)
    slope[np.arange(n), vocabulary.class_of[outputs]] -= 1
    slope *= np.float32(rate / n)
    back = slope @ p[3].T
    if len(who):
        mine = hidden.T.take(who, axis=1)
        ahead, odds = turns(p, sides, forks, mine)
        turn = -sides * (odds / (1 + odds))
        first = _starts(who)
        ahead *= turn
        back[who[first]] += np.float32(rate / n) * np.add.reduceat(ahead, first, axis=1).T
        order = np.argsort(forks, kind="stable")
        mine *= turn
        first = _starts(forks[order])
        at = forks[order[first]]
        passed = np.diff(np.append(first, len(order)))
        step = (fork_rate / np.maximum(passed, FORK_LEAST)).astype(np.float32)
        p[5][at] -= (step * np.add.reduceat(mine.take(order, axis=1), first, axis=1)).T
        p[6][at] -= step * np.add.reduceat(turn[order], first)
    inner = back * (1 - hidden * hidden)
    outer = (inner @ p[1].T).reshape(-1, WIDTH).T
    p[3] -= hidden.T @ slope
    p[4] -= slope.sum(axis=0)
    p[1] -= vectors.T @ inner
    p[2] -= inner.sum(axis=0)
    at = windows.reshape(-1)  # 16 bits, as forks have: sorted by radix
    order = np.argsort(at, kind="stable")
    first = _starts(at[order])
    p[0][at[order[first]]] -= np.add.reduceat(outer.take(order, axis=1), first, axis=1).T


def _pack(p: list[np.ndarray]) -> bytes:
    return np.concatenate([x.reshape(-1) for x in p]).astype("<f4").tobytes()


def _unpack(flat: np.ndarray, like: list[np.ndarray]) -> list[np.ndarray]:
    out, at = [], 0
    for x in like:
        out.append(flat[at : at + x.size].reshape(x.shape).astype(np.float32))
        at += x.size
    return out


def train(rows: DataFrame, vocabulary: Vocabulary, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The network's parameters, from all `rows`, each used in one round."""
    spark = rows.sparkSession
    now = first_parameters(vocabulary)
    known = spark.sparkContext.broadcast(vocabulary)
    schema = "task long, words long, mean binary"

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total, words = 0.0, int(group["words"].sum())
        for n, mean in zip(group["words"], group["mean"], strict=True):
            total = total + np.frombuffer(mean, dtype="<f4").astype(np.float64) * (n / words)
        return pd.DataFrame(
            {"task": [key[0]], "words": [words], "mean": [total.astype("<f4").tobytes()]}
        )

    for number in range(rounds):
        start = spark.sparkContext.broadcast(now)

        def fit(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            p = [x.copy() for x in start.value]
            task, seen, vocabulary = 0, 0, known.value
            for part in slices(batches):
                task = part.column("task")[0].as_py()
                words, owner = word_hashes(part.column("text"))
                outputs = vocabulary.outputs(words)[0]
                windows = vocabulary.windows(outputs, owner)
                for at in range(0, len(outputs), BATCH):
                    some = slice(at, at + BATCH)
                    train_batch(p, vocabulary, windows[some], outputs[some], RATE, FORK_RATE)
                seen += len(outputs)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([task]), pa.array([seen]), pa.array([_pack(p)], pa.binary())],
                    ["task", "words", "mean"],
                )

        mine = rows.filter(F.pmod(F.xxhash64("text"), F.lit(rounds)) == number)
        with Scratch(spark) as scratch:
            fitted = scratch.store(
                mine.select(F.spark_partition_id().cast("long").alias("task"), "text").mapInArrow(
                    fit, schema
                ),
                "fitted",
            )
            tasks = (fitted.agg(F.max("task")).first()[0] or 0) + 1
            while tasks > 1:
                fitted = (
                    fitted.withColumn("task", F.floor(F.col("task") / FAN_IN))
                    .groupBy("task")
                    .applyInPandas(add, schema)
                )
                tasks = math.ceil(tasks / FAN_IN)
            for r in fitted.collect():  # one row
                now = _unpack(np.frombuffer(bytes(r["mean"]), dtype="<f4"), now)
    return now


def score(
    rows: DataFrame, counts: DataFrame, vocabulary: Vocabulary, parameters: list[np.ndarray]
) -> DataFrame:
    """(doc_id, n_words, log_prob, mean_log_prob) of rows (doc_id, text).

    The network's part is summed where a text is; words of buckets meet `counts` in a join, and
    one aggregation per row adds the logarithms of their counts.
    """
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((vocabulary, parameters))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary, p = sent.value
        words, owner = word_hashes(batch.column("text"))
        outputs, rare = vocabulary.outputs(words)
        windows = vocabulary.windows(outputs, owner)
        logs = np.zeros(len(outputs))
        for at in range(0, len(outputs), BATCH):
            some = slice(at, at + BATCH)
            logs[some] = log_outputs(p, vocabulary, windows[some], outputs[some])
        logs[rare] -= vocabulary.log_total[outputs[rare] - len(vocabulary.words)]
        cuts = np.searchsorted(owner[rare], np.arange(batch.num_rows + 1))
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(per_document(np.ones(len(owner)), owner, batch.num_rows)),
                pa.array(np.bincount(owner, weights=logs, minlength=batch.num_rows).astype(float)),
                pa.LargeListArray.from_arrays(cuts, pa.array(as_signed(words[rare]))).cast(
                    pa.list_(pa.int64())
                ),
            ],
            ["doc_id", "n_words", "log_prob", "rare"],
        )

    with Scratch(spark) as scratch:
        judged = scratch.store(
            arrow_map(
                rows, judge, "doc_id long, n_words long, log_prob double, rare array<long>"
            ).withColumn("row", F.monotonically_increasing_id()),
            "judged",
        )
        found = judged.select("row", F.explode("rare").alias("word")).join(counts, "word", "left")
        rest = found.select(
            "row",
            F.lit(None).cast("long").alias("doc_id"),
            F.lit(0).cast("long").alias("n_words"),
            F.log(F.coalesce(F.col("n").cast("double"), F.lit(UNSEEN))).alias("log_prob"),
        )
        summed = (
            judged.select("row", "doc_id", "n_words", "log_prob")
            .unionAll(rest)
            .groupBy("row")
            .agg(
                F.max("doc_id").alias("doc_id"),
                F.sum("n_words").alias("n_words"),
                F.sum("log_prob").alias("log_prob"),
            )
        )
        return durable(
            summed.select(
                "doc_id",
                "n_words",
                "log_prob",
                F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias(
                    "mean_log_prob"
                ),
            ),
            "scores",
        )


def pseudo_likelihood(
    docs: DataFrame, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Train on all of `docs` and score all of them."""
    rows = texts(docs, doc_id, text)
    with Scratch(docs.sparkSession) as scratch:
        counts = scratch.store(word_counts(rows), "word-counts")
        vocabulary = Vocabulary(*split_counts(counts))
        return score(rows, counts, vocabulary, train(rows, vocabulary, rounds))
