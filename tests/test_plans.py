"""The physical plans are the ones meant for large tables."""

import datetime as dt

import pytest

from helpers import customers, inventory, orders, products, warehouses
from stockweave.operators import cleaning, demand, gold, reports, segments, staging
from stockweave.operators.warehouses import warehouse_scoring


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "fact_orders")
    orders(spark, {}, {}).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(gold.product_performance(stored))
    assert "PushedFilters: [IsNotNull(quantity), GreaterThan(quantity,0)]" in text
    assert (
        "ReadSchema: struct<order_line_id:bigint,product_id:bigint,quantity:int,"
        "total_amount:decimal(18,2)>" in text
    )
    staged = plan(staging.stg_orders(stored))
    assert "GreaterThan(quantity,0)" in staged and "GreaterThan(total_amount,0.00)" in staged
    assert "Not(EqualTo(order_status,Cancelled))" in plan(segments.rfm_base(stored))


@pytest.mark.parametrize(
    "build,exchanges",
    [
        (gold.monthly_sales, 1),
        (gold.product_performance, 1),
        (segments.rfm_base, 1),
        (segments.churn_features, 2),
        (demand.demand_cells, 1),
        (demand.demand_features, 2),
        (lambda df: cleaning.clean_orders(df)[0], 1),
        (cleaning.reject_total, 0),
        (staging.stg_orders, 0),
    ],
)
def test_number_of_shuffles(stored, build, exchanges):
    text = plan(build(stored))
    assert text.count("Exchange hashpartitioning") == text.count("Exchange ") == exchanges
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_aggregates_are_partial_before_the_shuffle(stored):
    text = plan(segments.rfm_base(stored))
    assert text.index("Exchange") < text.index("partial_sum")


def test_orders_are_reduced_before_they_are_joined(spark, stored):
    for df in (
        warehouse_scoring(warehouses(spark, {}), stored),
        staging.customer_summary(
            staging.stg_orders(stored), staging.stg_customers(customers(spark, {})),
            dt.date(2024, 6, 1),
        ),
    ):
        text = plan(df)
        assert text.index("Join") < text.index("HashAggregate")


def test_large_dimensions_are_not_broadcast(spark, stored):
    dims = (products(spark, {}), warehouses(spark, {}), customers(spark, {}))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        text = plan(reports.executive_overview(stored, *dims))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert text.count("SortMergeJoin") == 3 and "Broadcast" not in text


def test_hot_key_of_a_star_join_is_split(spark):
    """One customer holds most order lines; adaptive execution splits that customer."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    lines = spark.range(0, 60000, 1, 6).selectExpr(
        "id AS order_line_id",
        "CASE WHEN id < 50000 THEN 7 ELSE id END AS customer_id",
        "CASE WHEN id >= 0 THEN 1 ELSE id END AS product_id",
        "CASE WHEN id >= 0 THEN 1 ELSE id END AS warehouse_id",
        "DATE '2024-01-01' AS order_date",
        "'Shipped' AS order_status",
        "CAST(1 AS DECIMAL(18,2)) AS total_amount",
        "1 AS quantity",
        "CAST(1 AS DECIMAL(18,2)) AS shipping_cost",
    )
    people = spark.range(60000).selectExpr("id AS customer_id", "'SMB' AS segment")
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        report = reports.executive_overview(
            lines, products(spark, {}), warehouses(spark, {}), people
        )
        assert len(report.collect()) == 60000
        assert "skew=true" in plan(report)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sizes_follow_the_input():
    from stockweave.session import sized_for

    small, large = sized_for(10**9), sized_for(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert 90_000 < int(large["spark.sql.shuffle.partitions"]) <= 100_000
    assert large["spark.sql.files.maxPartitionBytes"] == "256m"


def test_audit_scans_the_orders_once(spark, stored):
    others = (customers(spark, {}), products(spark, {}), inventory(spark, {}))
    text = plan(cleaning.cleaning_report(stored, *others))
    assert text.count("FileScan") == 1 and "Window" not in text
    assert text.index("partial_min") > text.index("Exchange hashpartitioning(order_line_id")


def test_shares_need_no_window(stored):
    assert "Window" not in plan(segments.segment_counts(stored, "order_status"))
