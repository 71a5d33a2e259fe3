"""Second-order boosted regression trees, grown from histograms that Spark sums.

Values become bins once: the borders are quantiles of the rows with the smallest hashes, a
sample that doesn't depend on how rows are spread. Binned rows are packed into blocks, which
stay where they are. A level of a tree is one aggregation: every block adds up the gradients and
Hessians of its rows by (node, feature, bin), Spark sums these, and the best split of each node
maximizes the gain with L2 regularization; rows with a missing value go to the side
that gains more. What reaches the driver is bounded by nodes x features x bins.

Gradients are summed as whole numbers of a fixed unit, so sums are exact and the trees are the
same under any partitioning and order of rows. Rows that make a single block need no sums over
blocks: their trees grow where the block is, by the same functions, in one job.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.learning import histograms
from stockweave.learning.histograms import (
    MISSING,
    Tree,
    best_splits,
    bin_values,
    boost_block,
    leaves,
    node_histograms,
)

SAMPLE = 16_384  # distinct rows that give the bin borders
BLOCK = 65_536  # rows handled at once
CUT_EVERY = 5  # trees that are added to the margins, and written down, at once
EXACT_BITS = 36  # of a gradient: with 2^16 rows a block's sums are exact in floating point

# The array functions travel with the tasks: executors need numpy, not this package.
cloudpickle.register_pickle_by_value(histograms)

_BLOCKS = "bins binary, target binary, margin binary"


@dataclass
class BoostedTrees:
    features: tuple[str, ...]
    base: float
    trees: list[Tree]

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the prediction for every row; null features are missing values."""
        base, trees = self.base, self.trees

        @F.pandas_udf("double")
        def predict(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                x = np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
                total = np.full(x.shape[1], base)
                for tree in trees:
                    total += tree.value[leaves(tree, x, tree.cut, np.isnan)]
                yield pd.Series(total)

        return df.withColumn(output, predict(*[F.col(c).cast("double") for c in self.features]))

    def save(self, path: str, spark: SparkSession) -> None:
        """One row per tree, and one with tree -1 for what they share."""
        rows = [
            (i, t.feature.tolist(), t.cut.tolist(), t.left.tolist(), t.value.tolist(), None, None)
            for i, t in enumerate(self.trees)
        ]
        rows.append((-1, None, None, None, None, list(self.features), self.base))
        spark.createDataFrame(
            rows,
            "tree int, feature array<int>, cut array<double>, `left` array<boolean>,"
            " value array<double>, features array<string>, base double",
        ).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["tree"])
        shared, *trees = rows
        return cls(
            tuple(shared["features"]),
            shared["base"],
            [
                Tree(
                    np.array(r["feature"], dtype=np.int64), np.zeros(len(r["feature"]), np.int64),
                    np.array(r["cut"]), np.array(r["left"], dtype=bool), np.array(r["value"]),
                )
                for r in trees
            ],
        )


def bin_borders(
    rows: DataFrame, features: Sequence[str], max_bins: int, sample: int = SAMPLE
) -> list[np.ndarray]:
    """Per feature the ascending values that start a new bin.

    Quantiles of the `sample` rows with the smallest hashes, or all distinct values where
    these are few. Copies of a row have one hash and count once.
    """
    names = list(features)
    picked = (
        rows.select(F.xxhash64(*names).alias("_draw"), *names)
        .distinct()
        .orderBy("_draw", *names)
        .limit(sample)
        .toPandas()
    )
    borders = []
    for name in names:
        values = picked[name].to_numpy(dtype=float, na_value=np.nan)
        values = np.sort(values[~np.isnan(values)])
        distinct = np.unique(values)
        if len(distinct) > max_bins:
            at = np.arange(1, max_bins) * len(values) // max_bins
            distinct = np.unique(values[np.concatenate([[0], at])])
        borders.append(distinct[1:])
    return borders


def _blocks(
    rows: DataFrame, target: str, borders: list[np.ndarray], base: float, size: int
) -> DataFrame:
    names = [c for c in rows.columns if c != target]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            bins = np.concatenate([b for b, _ in held], axis=1)
            y = np.concatenate([y for _, y in held])
            margin = np.full(len(y), base)
            return pa.RecordBatch.from_arrays(
                [pa.array([v.tobytes()], pa.binary()) for v in (bins, y, margin)],
                ["bins", "target", "margin"],
            )

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, size - sum(len(y) for _, y in held))
                at += part.num_rows
                columns = [
                    part.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names
                ]
                bins = np.stack([bin_values(c, b) for c, b in zip(columns, borders, strict=True)])
                y = part.column(target).to_numpy(zero_copy_only=False).astype(float)
                held.append((bins, y))
                if sum(len(y) for _, y in held) == size:
                    yield block()
                    held = []
        if held:
            yield block()

    return rows.mapInArrow(pack, _BLOCKS)


def _opened(batch: pa.RecordBatch, i: int, features: int):
    def numbers(name: str, kind) -> np.ndarray:
        return np.frombuffer(batch.column(name)[i].as_buffer(), dtype=kind)

    return (
        numbers("bins", np.uint8).reshape(features, -1),
        numbers("target", np.float64),
        numbers("margin", np.float64),
    )


def _grown(margin: np.ndarray, bins: np.ndarray, trees: Sequence[Tree]) -> np.ndarray:
    for tree in trees:
        margin = margin + tree.value[leaves(tree, bins, tree.bin, MISSING)]
    return margin


def _after(blocks: DataFrame, trees: Sequence[Tree], features: int) -> DataFrame:
    """The blocks with the trees' values added to the margins."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                bins, _, margin = _opened(batch, i, features)
                margin = _grown(margin, bins, trees)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("bins").slice(i, 1), batch.column("target").slice(i, 1),
                        pa.array([margin.tobytes()], pa.binary()),
                    ],
                    ["bins", "target", "margin"],
                )

    return blocks.mapInArrow(add, _BLOCKS)


def _level(
    blocks: DataFrame, added: Sequence[Tree], tree: Tree, depth: int, features: int, unit: float
) -> pa.Table:
    """(slot, gradient, hessian) summed over all rows at the nodes of a level; the margins of
    the blocks lack the trees `added`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for i in range(batch.num_rows):
                bins, target, margin = _opened(batch, i, features)
                margin = _grown(margin, bins, added)
                part = node_histograms(tree, bins, margin - target, depth, unit)
                total = part if total is None else (total[0] + part[0], total[1] + part[1])
        if total is not None:
            slot = np.flatnonzero(total[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(total[0][slot]), pa.array(total[1][slot])],
                ["slot", "gradient", "hessian"],
            )

    parts = blocks.mapInArrow(count, "slot long, gradient long, hessian long")
    sums = parts.groupBy("slot").agg(
        F.sum("gradient").alias("gradient"), F.sum("hessian").alias("hessian")
    )
    return sums.toArrow()


_TREES = (
    "tree int, feature array<long>, bin array<long>, cut array<double>, `left` array<boolean>,"
    " value array<double>"
)


def _boost_alone(
    blocks: DataFrame, borders: list[np.ndarray], rounds: int, *settings
) -> list[Tree]:
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [
            _opened(batch, i, len(borders)) for batch in batches for i in range(batch.num_rows)
        ]
        if not parts:
            return
        bins, target, margin = (np.concatenate(v, axis=-1) for v in zip(*parts, strict=True))
        trees = boost_block(bins, target, margin, borders, rounds, *settings)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(trees)), pa.int32()),
                *(
                    pa.array([getattr(t, name) for t in trees])
                    for name in ("feature", "bin", "cut", "left", "value")
                ),
            ],
            ["tree", "feature", "bin", "cut", "left", "value"],
        )

    rows = sorted(blocks.mapInArrow(grow, _TREES).collect(), key=lambda r: r["tree"])
    return [Tree(*(np.array(v) for v in row[1:])) for row in rows]


def _boost_levels(
    blocks: DataFrame,
    borders: list[np.ndarray],
    rounds: int,
    max_depth: int,
    unit: float,
    *settings: float,
) -> list[Tree]:
    features, tasks = len(borders), blocks.rdd.getNumPartitions()
    trees: list[Tree] = []
    written = 0
    blocks = blocks.persist(StorageLevel.MEMORY_AND_DISK)
    for _ in range(rounds):
        tree = Tree.empty(max_depth)
        for depth in range(max_depth):
            if not tree.open_at(depth):
                break
            sums = _level(blocks, trees[written:], tree, depth, features, unit)
            slot, gradient, hessian = (sums.column(i).to_numpy() for i in range(3))
            best_splits(
                tree, depth, borders, slot, gradient * unit, hessian.astype(float), *settings
            )
        trees.append(tree)
        if len(trees) - written == CUT_EVERY and len(trees) < rounds:
            grown = durable(_after(blocks, trees[written:], features), "boosting-blocks")
            blocks.unpersist()
            blocks = grown.coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
            written = len(trees)
    blocks.unpersist()
    return trees


def train_boosted(
    train: DataFrame,
    features: Sequence[str],
    target: str,
    rounds: int = 100,
    max_depth: int = 6,
    learning_rate: float = 0.1,
    l2: float = 1.0,
    min_child_weight: float = 1.0,
    max_bins: int = 254,
    block_rows: int = BLOCK,
) -> BoostedTrees:
    """Boost squared error. Rows without a target take no part; without any, all is 0."""
    names = list(features)
    rows = train.select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)],
        F.col(target).cast("double").alias("y"),
    ).filter(F.col("y").isNotNull())
    rows = durable(rows, "boosting-rows")
    xs = [f"x{i}" for i in range(len(names))]
    facts = rows.agg(
        F.count("*").alias("n"),
        F.sum(F.col("y").cast("decimal(30,6)")).alias("total"),
        F.max(F.abs("y")).alias("widest"),
    ).first()
    if not facts["n"]:
        return BoostedTrees(tuple(names), 0.0, [])
    base = float(facts["total"]) / facts["n"]
    borders = bin_borders(rows, xs, max_bins)
    if not 0 < block_rows <= BLOCK:
        raise ValueError(f"blocks have 1 to {BLOCK} rows")
    # gradients in units so small that the sum of all still fits 62 bits
    widest = 8 * (facts["widest"] + abs(base)) + 1.0
    bits = min(EXACT_BITS, 62 - math.ceil(math.log2(facts["n"] + 1)))
    unit = 2.0 ** (math.ceil(math.log2(widest)) - bits)
    tasks = math.ceil(facts["n"] / block_rows)
    packed = _blocks(rows.coalesce(tasks), "y", borders, base, block_rows)
    boost = _boost_alone if tasks == 1 else _boost_levels
    blocks = durable(packed, "boosting-blocks").coalesce(tasks)
    trees = boost(
        blocks, borders, rounds, max_depth, unit, learning_rate, l2, min_child_weight
    )
    return BoostedTrees(tuple(names), base, trees)
