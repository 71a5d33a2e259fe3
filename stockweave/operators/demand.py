"""Monthly demand cells and their lag, rolling and season features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.scalar import (
    month_start,
    ratio,
    round_half_even,
    season,
    season_number,
)

DEFAULT_KEYS = ("product_id", "warehouse_id")
TARGET = "total_quantity"


def demand_cells(orders: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Units, revenue and lines per key and calendar month, without cancelled orders."""
    return (
        orders.filter(F.col("order_status") != "Cancelled")
        .groupBy(*keys, F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(
            F.sum("quantity").alias("total_quantity"),
            F.sum("total_amount").cast("decimal(28,2)").alias("total_revenue"),
            F.count("order_line_id").alias("order_count"),
            ratio(F.sum("quantity"), F.count("quantity")).alias("avg_quantity"),
        )
    )


def _history(keys: Sequence[str]):
    # Cells are already one row per month, so a key's partition is as long as its history.
    return Window.partitionBy(*keys).orderBy("year", "month")


def add_lags(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, k: int = 3) -> DataFrame:
    """Values of the previous 1..k observed months; gaps are not filled."""
    w = _history(keys)
    return df.withColumns(
        {f"lag_{i}_qty": F.lag(TARGET, i).over(w) for i in range(1, k + 1)}
    )


def add_rolling(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, n: int = 3) -> DataFrame:
    """Mean of the previous n observed months, null unless all n exist."""
    w = _history(keys).rowsBetween(-n, -1)
    complete = F.count(TARGET).over(w) == n
    return df.withColumn(
        f"rolling_{n}m_avg", F.when(complete, ratio(F.sum(TARGET).over(w), F.lit(n)))
    )


def add_season(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"season": season(F.col("month")), "season_num": season_number(F.col("month"))}
    )


def demand_features(orders: DataFrame, keys: Sequence[str] = DEFAULT_KEYS) -> DataFrame:
    """Complete feature rows; lags and rolling mean share one window sort."""
    cells = demand_cells(orders, keys)
    return add_season(add_rolling(add_lags(cells, keys), keys)).na.drop("any")


def forecast_rows(
    predicted: DataFrame,
    prediction: Column,
    model_name: str,
    keys: Sequence[str] = DEFAULT_KEYS,
) -> DataFrame:
    """Rows of the forecast table: whole units, dated to the first of the month."""
    return predicted.select(
        *keys,
        month_start("year", "month").alias("forecast_date"),
        round_half_even(prediction).alias("predicted_demand"),
        F.lit(model_name).alias("model_name"),
    )
