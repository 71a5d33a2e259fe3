"""Star-join extracts for reporting.

No join is hinted: Spark broadcasts a dimension only when its measured size is under
`spark.sql.autoBroadcastJoinThreshold` and otherwise sort-merges, where adaptive
execution splits a hot key of the fact side over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.functions.scalar import stock_status


def executive_overview(
    orders: DataFrame, products: DataFrame, warehouses: DataFrame, customers: DataFrame
) -> DataFrame:
    """Order lines with all three dimensions; lines with a null or unknown key drop.

    The dimension with the least text is joined first and that with the most last, as each
    join of two large sides moves what the joins before it added to the lines.
    """
    return (
        orders.join(
            customers.select("customer_id", F.col("segment").alias("customer_segment")),
            "customer_id",
        )
        .join(warehouses.select("warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .join(
            products.select("product_id", "category", "sub_category", "product_name"), "product_id"
        )
        .select(
            "order_date",
            "order_status",
            "total_amount",
            "quantity",
            "shipping_cost",
            "category",
            "sub_category",
            "product_name",
            "warehouse_name",
            "region",
            "customer_segment",
        )
    )


def customer_analytics(customers: DataFrame, scores: DataFrame) -> DataFrame:
    return customers.join(scores, "customer_id", "left")


def forecast_report(
    forecasts: DataFrame, products: DataFrame, warehouses: DataFrame
) -> DataFrame:
    return (
        forecasts.join(products.select("product_id", "product_name", "category"), "product_id")
        .join(warehouses.select("warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .select(
            "forecast_date",
            "predicted_demand",
            "model_name",
            "product_name",
            "category",
            "warehouse_name",
            "region",
        )
    )


def inventory_report(
    inventory: DataFrame, products: DataFrame, warehouses: DataFrame
) -> DataFrame:
    return (
        inventory.filter(F.col("quantity_on_hand").isNotNull())
        .join(products.select("product_id", "product_name", "category"), "product_id")
        .join(warehouses.select("warehouse_id", "warehouse_name", "region"), "warehouse_id")
        .select(
            "product_id",
            "product_name",
            "category",
            "warehouse_name",
            "region",
            "quantity_on_hand",
            "reorder_point",
            "quantity_reserved",
            stock_status(F.col("quantity_on_hand"), F.col("reorder_point")).alias("stock_status"),
        )
    )
