"""Data-quality checks: uniqueness and completeness of the staging models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER_CHECKS = ("order_line_id", ("order_line_id", "customer_id", "quantity", "total_amount"))
CUSTOMER_CHECKS = ("customer_id", ("customer_id", "email"))


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    present = df.na.drop("any", subset=list(columns))
    return (
        present.groupBy(*columns)
        .agg(F.count("*").alias("row_count"))
        .filter(F.col("row_count") > 1)
    )


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count of every column from one pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "failing")


def check_suite(df: DataFrame, model: str, unique: str, not_null: Sequence[str]) -> DataFrame:
    """Both kinds of checks from one scan and one shuffle of counters."""
    per_key = df.groupBy(unique).agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null if c != unique],
    )
    absent = F.col(unique).isNull()

    def nulls(c: str):
        counted = F.when(absent, F.col("rows")) if c == unique else F.col(f"null_{c}")
        return F.coalesce(F.sum(counted), F.lit(0))

    counts = per_key.agg(
        F.count_if(~absent & (F.col("rows") > 1)).alias(f"unique_{unique}"),
        *[nulls(c).alias(f"not_null_{c}") for c in not_null],
    )
    return counts.unpivot([], counts.columns, "check_name", "failing").select(
        F.lit(model).alias("model"),
        "check_name",
        "failing",
        (F.col("failing") == 0).alias("passed"),
    )


def dq_report(staged_orders: DataFrame, staged_customers: DataFrame) -> DataFrame:
    """The eight checks of the staging models, one row each."""
    return check_suite(staged_orders, "stg_orders", *ORDER_CHECKS).unionByName(
        check_suite(staged_customers, "stg_customers", *CUSTOMER_CHECKS)
    )
