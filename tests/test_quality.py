from helpers import customers, orders
from stockweave.operators import quality, staging


def test_report(spark):
    staged = staging.stg_orders(
        orders(
            spark, {}, {"order_line_id": 1}, {"order_line_id": 1}, {"order_line_id": None},
            {"order_line_id": None}, {"order_line_id": 9, "customer_id": None},
        )
    )
    people = staging.stg_customers(customers(spark, {"email": None}, {"customer_id": 2}))
    got = {
        (r.model, r.check_name): (r.failing, r.passed)
        for r in quality.dq_report(staged, people).collect()
    }
    assert got == {
        ("stg_orders", "unique_order_line_id"): (1, False),
        ("stg_orders", "not_null_order_line_id"): (2, False),
        ("stg_orders", "not_null_customer_id"): (1, False),
        ("stg_orders", "not_null_quantity"): (0, True),
        ("stg_orders", "not_null_total_amount"): (0, True),
        ("stg_customers", "unique_customer_id"): (0, True),
        ("stg_customers", "not_null_customer_id"): (0, True),
        ("stg_customers", "not_null_email"): (0, True),
    }


def test_report_of_nothing(spark):
    none = staging.stg_orders(orders(spark, {}).limit(0))
    people = staging.stg_customers(customers(spark, {}).limit(0))
    assert all(r.passed for r in quality.dq_report(none, people).collect())


def test_single_checks(spark):
    df = orders(spark, {}, {"order_line_id": 1}, {"customer_id": None})
    assert [tuple(r) for r in quality.check_unique(df, ["order_line_id"]).collect()] == [(1, 2)]
    nulls = {r.column_name: r.failing for r in quality.check_not_null(df, ["customer_id", "quantity"]).collect()}
    assert nulls == {"customer_id": 1, "quantity": 0}
