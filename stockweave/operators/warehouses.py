"""Warehouse scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.scalar import days_between, ratio, round_half_up

ON_TIME_DAYS = 7


def warehouse_scoring(warehouses: DataFrame, orders: DataFrame) -> DataFrame:
    """Volume, revenue, punctuality and a weighted score per warehouse, best first.

    Orders are reduced to one row per warehouse before the join; a warehouse without
    orders keeps its row with a zero count and null measures.
    """
    on_time = days_between("delivery_date", "order_date") <= ON_TIME_DAYS
    totals = orders.groupBy("warehouse_id").agg(
        F.count("order_line_id").alias("n"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced"),
        F.count_if(on_time).alias("on_time"),
        F.count_if(F.col("order_status") == "Cancelled").alias("cancelled"),
    )
    n, revenue = F.col("n"), F.col("revenue")
    mean = ratio(revenue, F.col("priced"))
    score = n * F.lit(0.3) / 100 + revenue.cast("double") * F.lit(0.0001) + mean * F.lit(0.01)
    return (
        warehouses.select("warehouse_id", "warehouse_name", "region")
        .join(totals, "warehouse_id", "left")
        .select(
            "warehouse_id",
            "warehouse_name",
            "region",
            F.coalesce(n, F.lit(0)).alias("total_orders"),
            F.round(revenue, 2).cast("decimal(28,2)").alias("total_revenue"),
            round_half_up(mean).alias("avg_order_value"),
            round_half_up(ratio(F.col("on_time") * F.lit(100.0), n)).alias("on_time_pct"),
            round_half_up(ratio(F.col("cancelled") * F.lit(100.0), n)).alias("cancellation_pct"),
            round_half_up(score).alias("performance_score"),
        )
        .orderBy(F.desc_nulls_last("performance_score"), "warehouse_id")
    )
