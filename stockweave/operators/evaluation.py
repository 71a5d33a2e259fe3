"""Train/test split and model metrics. Sums run over decimals, so the figures do not
depend on the order in which partitions arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.scalar import ratio

NO_MAPE = 999.0
_ERROR = "decimal(28,8)"


def hash_split(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add `is_test`, true for about 20% of the keys: the same rows on any partitioning."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.withColumn("is_test", F.substring(F.md5(text), 1, 2) < "33")


def forecast_metrics(
    df: DataFrame, actual: str, predicted: str, min_actual: float = 10, max_mae: float = 50
) -> DataFrame:
    """MAE, and MAPE over rows whose actual value exceeds `min_actual`, as one row."""
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    error = F.abs(a - p)
    large = a > min_actual
    share = F.when(large, F.try_divide(error, F.abs(a))).cast(_ERROR)
    mae = ratio(F.sum(error.cast(_ERROR)), F.count(error))
    return df.agg(
        F.count(error).alias("row_count"),
        mae.alias("mae"),
        F.coalesce(ratio(F.sum(share), F.count(share)) * 100, F.lit(NO_MAPE)).alias("mape"),
        (mae < max_mae).alias("passed"),
    )


def accuracy(
    df: DataFrame, label: str, prediction: Column | str, threshold: float = 0.65
) -> DataFrame:
    predicted = F.col(prediction) if isinstance(prediction, str) else prediction
    share = ratio(F.count_if(F.col(label) == predicted), F.count("*"))
    return df.agg(
        F.count("*").alias("row_count"),
        share.alias("accuracy"),
        (share > threshold).alias("passed"),
    )
