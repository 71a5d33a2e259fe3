"""Churn classification with a random forest."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.operators.evaluation import accuracy, hash_split
from stockweave.operators.segments import churn_score_rows

# Recency defines the label and is therefore not a feature.
FEATURES = (
    "frequency",
    "monetary",
    "avg_order_value",
    "unique_products",
    "unique_warehouses",
    "cancel_rate",
)


def complete_features(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(features without nulls, one row with the number of nulls filled per feature).

    A customer whose totals are all missing has no known spend: 0 stands for it.
    """
    counts = features.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in FEATURES])
    filled = features.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in FEATURES}
    )
    return filled, counts


def train_churn(
    train: DataFrame, num_trees: int = 100, max_depth: int = 10, seed: int = 42
) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(
        labelCol="churned",
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        # deep forests: remember each row's node, and split many nodes per pass
        cacheNodeIds=True,
        maxMemoryInMB=512,
    )
    return Pipeline(stages=[assembler, forest]).fit(train)


def churn_probability() -> Column:
    return vector_to_array(F.col("probability"))[1]


def score_churn(
    model: PipelineModel, features: DataFrame, as_of: dt.date | None = None
) -> DataFrame:
    """Score rows of every customer."""
    return churn_score_rows(model.transform(features), churn_probability(), as_of)


def churn_scores(
    features: DataFrame, as_of: dt.date | None = None, **training
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(model, scores of all customers, accuracy on the held-out ones)."""
    ready = complete_features(features)[0]
    split = durable(hash_split(ready, ["customer_id"]), "churn-features")
    model = train_churn(split.filter(~F.col("is_test")), **training)
    tested = model.transform(split.filter("is_test"))
    return (
        model,
        score_churn(model, split, as_of),
        accuracy(tested, "churned", F.col("prediction").cast("int")),
    )
