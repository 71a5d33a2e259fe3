"""Staging models and the customer mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.scalar import (
    as_of_date,
    days_between,
    ratio,
    round_half_up,
    value_segment,
)
from stockweave.operators.cleaning import UNKNOWN_EMAIL
from stockweave.schemas import ORDERS


def stg_orders(orders: DataFrame) -> DataFrame:
    """Positive order lines with delivery time; duplicates and unknown customers stay."""
    return orders.filter((F.col("quantity") > 0) & (F.col("total_amount") > 0)).select(
        *ORDERS.names,
        days_between("delivery_date", "order_date").alias("delivery_days"),
        F.when(F.col("order_status") == "Delivered", 1).otherwise(0).alias("is_delivered"),
    )


def stg_customers(
    customers: DataFrame, as_of: dt.date | None = None, unknown_email: str = UNKNOWN_EMAIL
) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_name",
        F.coalesce("email", F.lit(unknown_email)).alias("email"),
        "segment",
        "city",
        "state",
        "country",
        "registration_date",
        days_between(as_of_date(as_of), "registration_date").alias("customer_age_days"),
    )


def customer_summary(
    staged_orders: DataFrame,
    staged_customers: DataFrame,
    as_of: dt.date | None = None,
    mid: float = 10_000,
    high: float = 50_000,
) -> DataFrame:
    """One row per customer. Orders are reduced to one row per customer before the join,
    so the join never sees a heavy customer."""
    metrics = staged_orders.groupBy("customer_id").agg(
        F.count("order_line_id").alias("total_orders"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("priced"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum(F.when(F.col("order_status") == "Returned", 1).otherwise(0)).alias("total_returns"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("timed"),
    )
    return staged_customers.join(metrics, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "segment",
        "city",
        "state",
        "customer_age_days",
        "total_orders",
        F.round("revenue", 2).cast("decimal(28,2)").alias("total_revenue"),
        round_half_up(ratio(F.col("revenue"), F.col("priced"))).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        days_between(as_of_date(as_of), "last_order_date").alias("recency_days"),
        "total_returns",
        round_half_up(ratio(F.col("days"), F.col("timed")), 1).alias("avg_delivery_days"),
        value_segment(F.col("revenue"), mid, high).alias("value_segment"),
    )
