"""Recency-frequency-monetary segmentation, churn features and risk bins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.functions.scalar import (
    as_of_date,
    days_between,
    ratio,
    rfm_segment,
    risk_segment,
    round_half_up,
)
from stockweave.operators.ranking import global_ntile


def rfm_base(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Recency, frequency and spend per customer over orders that were not cancelled."""
    return (
        orders.filter(F.col("order_status") != "Cancelled")
        .groupBy("customer_id")
        .agg(
            days_between(as_of_date(as_of), F.max("order_date")).alias("recency_days"),
            F.count("order_line_id").alias("frequency"),
            F.sum("total_amount").cast("decimal(28,2)").alias("monetary"),
        )
    )


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintiles over all customers; ties are broken by `customer_id`."""
    return global_ntile(
        base,
        5,
        {
            "r_score": -F.col("recency_days"),
            "f_score": F.col("frequency"),
            "m_score": F.col("monetary") * 100,
        },
        tiebreak="customer_id",
    )


def rfm_segmentation(orders: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Best customers first. The tiebreak in the sort also keeps its range partitions even,
    as there are only 13 different totals."""
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (
        rfm_scores(rfm_base(orders, as_of))
        .withColumn("total_score", total)
        .select(
            "customer_id",
            "recency_days",
            "frequency",
            F.round("monetary", 2).cast("decimal(28,2)").alias("monetary"),
            "r_score",
            "f_score",
            "m_score",
            "total_score",
            rfm_segment(F.col("total_score")).alias("segment"),
        )
        .orderBy(F.desc("total_score"), "customer_id")
    )


def churn_features(
    orders: DataFrame, as_of: dt.date | None = None, horizon: int = 90
) -> DataFrame:
    """One row per customer with a 0/1 label: no order in the last `horizon` days.

    Cancelled orders count here. The two distinct counts make Spark aggregate by
    (customer, value) first, which also spreads the rows of a heavy customer.
    """
    n = F.count("order_line_id")
    cancelled = F.count_if(F.col("order_status") == "Cancelled")
    return (
        orders.groupBy("customer_id")
        .agg(
            days_between(as_of_date(as_of), F.max("order_date")).alias("recency_days"),
            n.alias("frequency"),
            F.sum("total_amount").cast("decimal(28,2)").alias("monetary"),
            ratio(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value"),
            F.count_distinct("product_id").alias("unique_products"),
            F.count_distinct("warehouse_id").alias("unique_warehouses"),
            ratio(cancelled, n).alias("cancel_rate"),
        )
        .withColumn("churned", F.when(F.col("recency_days") > horizon, 1).otherwise(0))
    )


def churn_score_rows(
    scored: DataFrame, probability: Column, as_of: dt.date | None = None
) -> DataFrame:
    """Rows of the score table; bins are cut before the probability is rounded."""
    return scored.select(
        "customer_id",
        round_half_up(probability, 4).alias("churn_probability"),
        risk_segment(probability).alias("risk_segment"),
        as_of_date(as_of).alias("scored_date"),
    )


def segment_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage of each value."""
    counts = df.groupBy(F.col(column).alias("segment")).agg(F.count("*").alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("n")).scalar()
    share = ratio(F.col("row_count") * F.lit(100.0), total)
    return counts.withColumn("share_pct", round_half_up(share))
