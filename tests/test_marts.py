import datetime as dt
from decimal import Decimal

from helpers import DAY, customers, inventory, orders, products, warehouses
from stockweave.operators import gold, reports, segments, staging
from stockweave.operators.warehouses import warehouse_scoring

AS_OF = dt.date(2024, 6, 1)


def days_before(n):
    return AS_OF - dt.timedelta(days=n)


def test_staging_keeps_duplicates_and_unknown_customers(spark):
    df = orders(
        spark, {"customer_id": None}, {"order_line_id": 1}, {"quantity": -1},
        {"total_amount": Decimal("-2.00")}, {"order_status": "Shipped"},
    )
    rows = staging.stg_orders(df).collect()
    assert sorted((r.order_line_id, r.is_delivered) for r in rows) == [(1, 1), (1, 1), (5, 0)]
    assert {r.delivery_days for r in rows} == {5}


def test_customer_summary(spark):
    staged = staging.stg_orders(
        orders(
            spark,
            {"customer_id": 1, "total_amount": Decimal("10000.00")},
            {"customer_id": 2, "total_amount": Decimal("10000.01")},
            {"customer_id": 3, "total_amount": Decimal("30000.00"), "order_status": "Returned"},
            {"customer_id": 3, "total_amount": Decimal("20000.01"), "order_date": days_before(3),
             "delivery_date": AS_OF},
        )
    )
    people = staging.stg_customers(
        customers(spark, *[{"customer_id": i} for i in (1, 2, 3, 4)]), AS_OF
    )
    got = {r.customer_id: r for r in staging.customer_summary(staged, people, AS_OF).collect()}
    assert {i: r.value_segment for i, r in got.items()} == {
        1: "Low Value", 2: "Mid Value", 3: "High Value", 4: "Low Value",
    }
    third, idle = got[3], got[4]
    assert (third.total_orders, third.total_returns, third.recency_days) == (2, 1, 3)
    assert third.total_revenue == Decimal("50000.01") and third.avg_order_value == 25000.01
    assert third.avg_delivery_days == 4.0 and third.first_order_date == DAY
    assert idle.total_orders is None and idle.total_revenue is None and idle.recency_days is None


def test_gold_reads_raw_rows(spark):
    df = orders(
        spark, {"customer_id": None}, {"order_line_id": 1}, {"quantity": -1},
        {"total_amount": Decimal("-6.00")},
    )
    row = gold.monthly_sales(df).first()
    assert (row.year_month, row.total_orders, row.total_revenue, row.total_quantity) == (
        "2024-01", 3, Decimal("66.00"), 12,
    )
    assert row.avg_order_value == 22.0
    assert gold.product_performance(df).first().total_orders == 3
    assert gold.warehouse_performance(df).first().avg_order_val == 22.0


def test_warehouse_score(spark):
    df = orders(
        spark,
        {"warehouse_id": 1, "delivery_date": DAY + dt.timedelta(days=7)},
        {"warehouse_id": 1, "delivery_date": DAY + dt.timedelta(days=8), "order_status": "Cancelled"},
        {"warehouse_id": 1, "delivery_date": DAY, "total_amount": Decimal("100.00")},
    )
    rows = warehouse_scoring(warehouses(spark, {}, {"warehouse_id": 2}), df).collect()
    assert [r.warehouse_id for r in rows] == [1, 2]  # the idle warehouse is last
    busy, idle = rows
    assert (busy.total_orders, busy.on_time_pct, busy.cancellation_pct) == (3, 66.67, 33.33)
    assert busy.performance_score == round(3 * 0.3 / 100 + 172 * 0.0001 + 172 / 3 * 0.01, 2)
    assert idle.total_orders == 0 and idle.performance_score is None


def test_star_join_drops_unknown_keys(spark):
    df = orders(spark, {}, {"customer_id": None}, {"product_id": 99}, {"warehouse_id": 99})
    out = reports.executive_overview(
        df,
        products(spark, {"product_id": 3}),
        warehouses(spark, {"warehouse_id": 2}),
        customers(spark, {"customer_id": 7}),
    )
    assert out.count() == 1 and out.first().customer_segment == "SMB"


def test_stock_status_bounds(spark):
    inv = inventory(
        spark,
        *[dict(inventory_id=i, quantity_on_hand=q) for i, q in enumerate([10, 20, 21, 9, 0, None])],
    )
    rows = reports.inventory_report(inv, products(spark, {}), warehouses(spark, {})).collect()
    assert {r.quantity_on_hand: r.stock_status for r in rows} == {
        10: "Normal", 20: "Normal", 21: "Overstocked", 9: "Understocked", 0: "Understocked",
    }


def test_customers_without_scores_stay(spark):
    scores = spark.createDataFrame(
        [(1, 0.5, "Medium Risk", AS_OF)],
        "customer_id long, churn_probability double, risk_segment string, scored_date date",
    )
    out = reports.customer_analytics(customers(spark, {}, {"customer_id": 2}), scores)
    assert {r.customer_id: r.risk_segment for r in out.collect()} == {1: "Medium Risk", 2: None}


def test_rfm_excludes_cancelled_and_churn_does_not(spark):
    df = orders(
        spark,
        {"customer_id": 1, "order_date": days_before(90)},
        {"customer_id": 2, "order_date": days_before(91), "product_id": 4},
        {"customer_id": 2, "order_date": days_before(200), "order_status": "Cancelled"},
        {"customer_id": 3, "order_status": "Cancelled"},
    )
    base = {r.customer_id: r for r in segments.rfm_base(df, AS_OF).collect()}
    assert set(base) == {1, 2} and base[2].frequency == 1 and base[2].recency_days == 91
    churn = {r.customer_id: r for r in segments.churn_features(df, AS_OF).collect()}
    assert {i: r.churned for i, r in churn.items()} == {1: 0, 2: 1, 3: 1}
    assert (churn[2].unique_products, churn[2].unique_warehouses, churn[2].cancel_rate) == (2, 1, 0.5)


def test_rfm_segments(spark):
    rows = []
    for i in range(10):
        rows += [
            {"order_line_id": 100 * i + n, "customer_id": i, "order_date": days_before(100 - i)}
            for n in range(i + 1)
        ]
    out = segments.rfm_segmentation(orders(spark, *rows), AS_OF).collect()
    assert [r.customer_id for r in out] == [8, 9, 6, 7, 4, 5, 2, 3, 0, 1]
    assert [r.segment for r in out][::2] == ["VIP", "Loyal", "Potential", "At Risk", "Lost"]


def test_risk_bins(spark):
    p = [0.0, 0.3, 0.30001, 0.6, 0.60001, 1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(p)], "customer_id long, p double")
    out = segments.churn_score_rows(df, df.p, AS_OF).orderBy("customer_id").collect()
    assert [r.risk_segment for r in out] == [
        None, "Low Risk", "Medium Risk", "Medium Risk", "High Risk", "High Risk",
    ]
    shares = segments.segment_counts(df.selectExpr("p > 0.5 AS big"), "big").collect()
    assert {r.segment: (r.row_count, r.share_pct) for r in shares} == {
        True: (3, 50.0), False: (3, 50.0),
    }
