"""Demand forecasting with boosted regression trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.learning.boosting import BoostedTrees, train_boosted
from stockweave.operators.demand import DEFAULT_KEYS, TARGET, forecast_rows
from stockweave.operators.evaluation import forecast_metrics, hash_split

CALENDAR = ("month", "year", "season_num")
HISTORY = ("lag_1_qty", "lag_2_qty", "lag_3_qty", "rolling_3m_avg")
MODEL_NAME = "boosted_trees"


def split_features(
    features: DataFrame, keys: Sequence[str] = DEFAULT_KEYS
) -> tuple[DataFrame, DataFrame]:
    """(training rows, held-out rows), from features that are computed once: training
    passes over them many times. Rows without one of the keys belong to no cell and stay out."""
    features = features.na.drop("any", subset=[*keys])
    split = durable(hash_split(features, [*keys, "year", "month"]), "demand-features")
    return split.filter(~F.col("is_test")), split.filter("is_test")


def train_demand(
    train: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    max_iter: int = 100,
    max_depth: int = 6,
    step_size: float = 0.1,
) -> BoostedTrees:
    return train_boosted(
        train, [*keys, *CALENDAR, *HISTORY], TARGET, max_iter, max_depth, step_size
    )


def demand_forecast(
    features: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, **training
) -> tuple[BoostedTrees, DataFrame, DataFrame]:
    """(model, forecasts of the held-out rows, their error)."""
    train, held_out = split_features(features, keys)
    model = train_demand(train, keys, **training)
    predicted = model.transform(held_out)
    return (
        model,
        forecast_rows(predicted, F.col("prediction"), MODEL_NAME, keys),
        forecast_metrics(predicted, TARGET, "prediction"),
    )
