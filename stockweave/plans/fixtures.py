"""The driver's Parquet tables reshaped to the star schema (see FIXTURES.md, part B).

Only integer and decimal arithmetic is used, so another engine computes the same cells.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2001, 8, 2)

# What "first" means where one order line id has conflicting rows.
ORDER_TIEBREAK = (
    "product_id",
    "warehouse_id",
    "quantity",
    "unit_price",
    "discount_pct",
    "total_amount",
    "order_status",
    "shipping_cost",
)


def _scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _on(left: str, right: str) -> Column:
    return F.col(left) == F.col(right)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _scan(spark, sf_dir, "lineitem").join(
        _scan(spark, sf_dir, "orders"), _on("l_orderkey", "o_orderkey")
    )
    base = lines.selectExpr(
        "l_orderkey * 10 + l_linenumber AS order_line_id",
        "CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE o_custkey END AS customer_id",
        "l_partkey AS product_id",
        "l_suppkey AS warehouse_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "CASE WHEN (l_orderkey + l_linenumber) % 25 = 0 THEN NULL ELSE"
        " date_add(CAST(o_orderdate AS DATE), CAST(1 + l_partkey % 5 AS INT)) END AS ship_date",
        "date_add(CAST(o_orderdate AS DATE),"
        " CAST(2 + l_partkey % 5 + l_suppkey % 7 AS INT)) AS delivery_date",
        "CASE WHEN l_partkey % 33 = 0 THEN -CAST(l_quantity AS INT)"
        " ELSE CAST(l_quantity AS INT) END AS quantity",
        "CAST(CAST(1000 + (l_partkey * 7919 + l_suppkey * 104729) % 99001 AS DECIMAL(12,0))"
        " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(15,2)) AS unit_price",
        "CAST(l_discount AS DECIMAL(4,2)) AS discount_pct",
        "CAST(l_quantity AS DECIMAL(4,0)) AS ordered",
        "(l_orderkey + l_partkey) % 50 = 7 AS negated",
        "CASE WHEN l_returnflag = 'R' AND o_orderstatus = 'F' THEN 'Returned'"
        " WHEN l_returnflag = 'A' AND o_orderstatus = 'O' THEN 'Cancelled'"
        " WHEN o_orderstatus = 'F' THEN 'Delivered'"
        " WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Processing' END AS order_status",
        "CAST(CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_tax AS DECIMAL(4,2))"
        " AS DECIMAL(18,2)) AS shipping_cost",
    )
    amount = (
        "CAST(unit_price * ordered * (CAST(1 AS DECIMAL(4,2)) - discount_pct) AS DECIMAL(18,2))"
    )
    return base.selectExpr(
        "order_line_id",
        "customer_id",
        "product_id",
        "warehouse_id",
        "order_date",
        "ship_date",
        "delivery_date",
        "quantity",
        "unit_price",
        "discount_pct",
        f"CAST(CASE WHEN negated THEN -{amount} ELSE {amount} END AS DECIMAL(18,2))"
        " AS total_amount",
        "order_status",
        "shipping_cost",
    )


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir, "nation").join(
        _scan(spark, sf_dir, "region"), _on("n_regionkey", "r_regionkey")
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _scan(spark, sf_dir, "customer")
        .join(_geography(spark, sf_dir), _on("c_nationkey", "n_nationkey"))
        .selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE"
            " concat('c', CAST(c_custkey AS STRING), '@example.com') END AS email",
            "c_mktsegment AS segment",
            "n_name AS city",
            "n_name AS state",
            "r_name AS country",
            "date_add(DATE '1990-01-01', CAST(c_custkey % 1600 AS INT)) AS registration_date",
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "p_brand AS sub_category",
        "CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE"
        " CAST(p_retailprice * 0.6D AS DECIMAL(18,2)) END AS cost_price",
        "CAST(p_retailprice AS DECIMAL(18,2)) AS list_price",
    )


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _scan(spark, sf_dir, "supplier")
        .join(_geography(spark, sf_dir), _on("s_nationkey", "n_nationkey"))
        .selectExpr(
            "s_suppkey AS warehouse_id",
            "s_name AS warehouse_name",
            "n_name AS city",
            "n_name AS state",
            "r_name AS region",
            "CAST(20000 + (s_suppkey * 977) % 30000 AS INT) AS capacity",
        )
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = (
        _scan(spark, sf_dir, "lineitem")
        .selectExpr("l_partkey AS p", "l_suppkey AS w")
        .distinct()
    )
    return pairs.selectExpr(
        "p * 100000 + w AS inventory_id",
        "p AS product_id",
        "w AS warehouse_id",
        "DATE '2001-08-02' AS snapshot_date",
        "CASE WHEN (p + w) % 50 = 0 THEN NULL ELSE"
        " CAST((p * 37 + w * 101) % 501 AS INT) END AS quantity_on_hand",
        "CAST((p * 11 + w * 3) % (1 + least((p * 37 + w * 101) % 501, 100)) AS INT)"
        " AS quantity_reserved",
        "CAST(20 + (p * 13 + w * 7) % 81 AS INT) AS reorder_point",
    )


def demand_orders(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """Order lines at a grain with enough history: brand and region in place of
    product and warehouse."""
    orders = raw_orders(spark, sf_dir) if orders is None else orders
    brand = _scan(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "CAST(substring(p_brand, 7) AS BIGINT) AS brand_id"
    )
    region = (
        _scan(spark, sf_dir, "supplier")
        .join(_scan(spark, sf_dir, "nation"), _on("s_nationkey", "n_nationkey"))
        .selectExpr("s_suppkey AS warehouse_id", "CAST(n_regionkey AS BIGINT) AS region_id")
    )
    return orders.join(brand, "product_id").join(region, "warehouse_id")


DEMAND_KEYS = ("brand_id", "region_id")
