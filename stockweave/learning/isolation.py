"""Anomaly detection with an isolation forest.

Each tree is grown from a bounded random sample in a task of its own; the forest (at most
`trees` x 511 nodes) is broadcast and rows are scored where they are. The share of rows to
flag is cut at an exact percentile of the scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.functions.order_stats import percentile
from stockweave.learning import trees as tree_arrays
from stockweave.learning.trees import grow_tree, mean_path, path_lengths, uniforms
from stockweave.operators.ranking import head_of_groups

FEATURES = ("quantity", "unit_price", "total_amount", "shipping_cost", "discount_pct")
INPUTS = ("order_line_id", "customer_id", "product_id", "warehouse_id", *FEATURES)
SCORE = "isolation_score"
SCORE_STEPS = 10**9  # scores are kept to nine decimals

# The array functions travel with the tasks: executors need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(tree_arrays)

_TREE = "tree int, feature array<int>, cut array<double>, path array<double>"


@dataclass
class IsolationForest:
    features: tuple[str, ...]
    sample_size: int
    trees: DataFrame  # one row per tree

    def save(self, path: str) -> None:
        self.trees.select(
            "*",
            F.lit(self.sample_size).alias("sample_size"),
            F.array(*[F.lit(f) for f in self.features]).alias("features"),
        ).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForest:
        stored = spark.read.parquet(path)
        one = stored.select("sample_size", "features").first()
        return cls(
            tuple(one["features"]), one["sample_size"], stored.drop("sample_size", "features")
        )

    def score(self, df: DataFrame) -> DataFrame:
        """Add the isolation score of every row: near 1 for rows that are easily isolated."""
        rows = self.trees.orderBy("tree").collect()  # one row per tree
        if not rows:  # nothing to learn from: every row is as usual as any other
            return df.withColumn(SCORE, F.lit(0.5))
        forest = df.sparkSession.sparkContext.broadcast(
            tuple(np.array([r[c] for r in rows]) for c in ("feature", "cut", "path"))
        )
        scale = mean_path(self.sample_size) or 1.0

        @F.pandas_udf("double")
        def isolation_score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            feature, cut, path = forest.value
            for columns in batches:
                x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
                yield pd.Series(np.exp2(-path_lengths(x, feature, cut, path) / scale))

        inputs = [F.col(c).cast("double") for c in self.features]
        return df.withColumn(SCORE, F.round(isolation_score(*inputs), 9))


def _offered(numeric: DataFrame, names: list[str], trees: int, share: float) -> DataFrame:
    """(tree, draw, row, *names): every tree is offered a row with probability `share`."""
    draw = F.xxhash64("row", "tree").alias("draw")
    if share >= 1:
        every = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
        return numeric.select("row", *names, every).select("tree", draw, "row", *names)
    # the length of a run of trees that pass a row over: geometric, from a uniform number
    scale = 1.0 / math.log1p(-share)
    top = F.shiftrightunsigned(F.xxhash64("row", F.lit("first")), 11).cast("double")
    jump = F.floor(F.log((top + F.lit(0.5)) * F.lit(2.0**-53)) * F.lit(scale))
    starting = numeric.select("row", *names, jump.alias("tree")).filter(F.col("tree") < trees)

    def jump_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("tree")
            tree = batch.column(at).to_numpy()
            seed = batch.column("row").to_numpy().view(np.uint64)
            mine = np.arange(len(tree))
            k = 0
            while len(mine):
                yield batch.take(pa.array(mine)).set_column(
                    at, "tree", pa.array(tree.astype(np.int64))
                )
                k += 1
                u = uniforms(seed[mine], k)
                tree = tree + 1 + np.floor(np.log(u) * scale).astype(np.int64)
                keep = tree < trees
                mine, tree = mine[keep], tree[keep]

    offered = starting.mapInArrow(jump_on, starting.schema)
    return offered.withColumn("tree", F.col("tree").cast("int")).select(
        "tree", draw, "row", *names
    )


def fit_forest(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    trees: int = 100,
    sample_size: int = 256,
    seed: int = 42,
) -> IsolationForest:
    """Grow `trees` trees from `sample_size` random rows each.

    A row's hash says by how many trees to jump to the first one it is offered to, and from there
    to the next, so the work follows the number of draws and not rows x trees. Of the rows
    offered to it a tree takes those with the smallest hashes of its number and the row. The draw
    depends on the rows alone and not on how they are spread, and all rows take part at
    every size. Should a tree be offered too few, rows are offered to all trees.
    """
    numeric = df.select(
        F.xxhash64(*df.columns, F.lit(seed)).alias("row"),
        *[F.col(c).cast("double").alias(c) for c in features],
    ).na.drop("any", subset=[*features])
    names = list(features)
    rows = numeric.count()
    size = min(sample_size, rows)

    def drawn(share: float) -> DataFrame:
        order = [F.col("draw"), F.col("row"), *[F.col(c) for c in names]]
        return head_of_groups(_offered(numeric, names, trees, share), ["tree"], order, size)

    # four times the expected number: fewer than `size` is all but impossible
    share = min(1.0, 4 * size / rows + 64 / rows) if rows else 1.0
    samples = durable(drawn(share), "forest-samples")
    if samples.count() < size * trees:
        samples = drawn(1.0)
    depth = max(1, math.ceil(math.log2(max(2, size))))

    def grow(key: tuple, sample: pd.DataFrame) -> pd.DataFrame:
        ordered = sample.sort_values(["draw", "row", *names])
        rng = np.random.default_rng([seed, int(key[0])])
        feature, cut, path = grow_tree(ordered[names].to_numpy(dtype=float), depth, rng)
        return pd.DataFrame(
            {"tree": [int(key[0])], "feature": [feature], "cut": [cut], "path": [path]}
        )

    grown = durable(samples.groupBy("tree").applyInPandas(grow, _TREE), "forest")
    return IsolationForest(tuple(features), size, grown)


def detect_anomalies(
    orders: DataFrame,
    contamination: float = 0.05,
    features: Sequence[str] = FEATURES,
    **forest,
) -> tuple[IsolationForest, DataFrame]:
    """(forest, orders with `isolation_score`, `anomaly_score` -1 or 1, `is_anomaly` 1 or 0).

    The scores are written once; the percentile search and the result read them back.
    """
    model = fit_forest(orders, features, **forest)
    scored = durable(model.score(orders), "scored")
    step = (F.col(SCORE) * SCORE_STEPS + F.lit(0.5)).cast("long")
    steps = scored.select(step.alias("step"))
    rows = scored.count()
    cut = percentile(steps, "step", 1 - contamination, rows, 0, SCORE_STEPS) if rows else 0.0
    flagged = step > F.lit(cut)
    return model, scored.withColumns(
        {
            "anomaly_score": F.when(flagged, -1).otherwise(1),
            "is_anomaly": F.when(flagged, 1).otherwise(0),
        }
    )


def anomalies(detected: DataFrame) -> DataFrame:
    return detected.filter(F.col("is_anomaly") == 1)
