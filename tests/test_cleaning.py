import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import DAY, customers, ids, inventory, orders, products
from stockweave.operators import cleaning as c


def test_first_copy_decides_even_when_it_is_bad(spark):
    df = orders(
        spark,
        {"order_line_id": 1, "customer_id": None, "product_id": 1},
        {"order_line_id": 1, "customer_id": 9, "product_id": 2},
        {"order_line_id": 2},
    )
    clean, quarantine = c.clean_orders(df, ["product_id"])
    assert ids(clean) == [2]
    assert ids(quarantine) == [1]


def test_rules_in_sequence(spark):
    df = orders(
        spark,
        {},
        {"customer_id": None, "quantity": -1},
        {"quantity": -3, "total_amount": Decimal("-1.00")},
        {"quantity": 0},
        {"total_amount": Decimal("-1.00")},
        {"total_amount": Decimal("0.00")},
        {"quantity": None},
        {"total_amount": None},
    )
    reasons = {
        r.order_line_id: r.reject_reason for r in c.classify_orders(df).collect()
    }
    assert reasons == {
        1: None,
        2: c.MISSING_CUSTOMER,
        3: c.NON_POSITIVE_QUANTITY,
        4: c.NON_POSITIVE_QUANTITY,
        5: c.NON_POSITIVE_TOTAL,
        6: c.NON_POSITIVE_TOTAL,
        7: c.NON_POSITIVE_QUANTITY,
        8: c.NON_POSITIVE_TOTAL,
    }
    assert ids(c.silver_orders(df)) == [1]


def test_report_counts(spark):
    df = orders(
        spark, {}, {}, {"order_line_id": 1}, {"customer_id": None}, {"quantity": -1},
        {"quantity": None}, {"total_amount": Decimal("-5.00")},
    )
    report = c.cleaning_report(
        df,
        customers(spark, {"email": None}, {"customer_id": 2}),
        products(spark, {"cost_price": None}),
        inventory(spark, {"quantity_on_hand": None}, {"inventory_id": 2}),
    )
    got = {(r.table_name, r.measure): r.row_count for r in report.collect()}
    assert got == {
        ("orders", "start"): 7,
        ("orders", "after_dedupe"): 6,
        ("orders", "quarantined_no_customer"): 1,
        ("orders", "negative_quantity"): 1,
        ("orders", "negative_total"): 1,
        ("orders", "clean"): 2,
        ("orders", "removed"): 5,
        ("customers", "null_emails_fixed"): 1,
        ("customers", "clean"): 2,
        ("products", "null_costs_fixed"): 1,
        ("products", "clean"): 1,
        ("inventory", "null_quantities_fixed"): 1,
        ("inventory", "clean"): 2,
    }


def test_dates(spark):
    text = spark.createDataFrame(
        [("2024-01-01", "2024-01-02", "2024-01-05"), ("2024-01-01", "soon", "2024-01-05")],
        "order_date string, ship_date string, delivery_date string",
    )
    rows = c.parse_dates(text).collect()
    assert [r.ship_date for r in rows] == [dt.date(2024, 1, 2), None]
    bad = text.withColumn("order_date", F.lit("not a date"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        c.parse_dates(bad).collect()


def test_dimension_fills(spark):
    assert c.clean_customers(customers(spark, {"email": None}), "none@example.com").first().email == (
        "none@example.com"
    )
    assert c.clean_products(products(spark, {"cost_price": None})).first().cost_price == 0
    assert c.clean_inventory(
        inventory(spark, {"quantity_on_hand": None})
    ).first().quantity_on_hand == 0


def test_empty_inputs(spark):
    none = orders(spark, {}).limit(0)
    clean, quarantine = c.clean_orders(none)
    assert clean.count() == 0 and quarantine.count() == 0
    report = c.cleaning_report(
        none, customers(spark, {}).limit(0), products(spark, {}).limit(0),
        inventory(spark, {}).limit(0),
    )
    assert {r.row_count for r in report.collect()} == {0}


def test_null_keys_are_one_key(spark):
    df = orders(spark, {"order_line_id": None}, {"order_line_id": None}, {"order_line_id": 5})
    assert c.dedupe_first(df, ["order_line_id"]).count() == 2


_LINE = st.fixed_dictionaries(
    {
        "order_line_id": st.integers(1, 6),
        "customer_id": st.one_of(st.none(), st.integers(1, 3)),
        "quantity": st.one_of(st.none(), st.integers(-2, 3)),
        "total_amount": st.one_of(st.none(), st.sampled_from([Decimal("-1.00"), Decimal("2.50")])),
    }
)


@settings(max_examples=8, deadline=None)
@given(st.lists(_LINE, min_size=1, max_size=25))
def test_cleaning_partitions_the_deduplicated_input(spark, lines):
    df = orders(spark, *lines)
    order = ["quantity", "total_amount"]
    deduped = c.dedupe_first(df, ["order_line_id"], order)
    assert sorted(ids(deduped)) == sorted({line["order_line_id"] for line in lines})
    parts = [
        c.accepted(c.classify_orders(df, order)),
        *[
            c.rejected(c.classify_orders(df, order), reason)
            for reason in (c.MISSING_CUSTOMER, c.NON_POSITIVE_QUANTITY, c.NON_POSITIVE_TOTAL)
        ],
    ]
    assert sorted(i for p in parts for i in ids(p)) == ids(deduped)
    once = sorted(map(tuple, deduped.collect()), key=repr)
    again = sorted(map(tuple, c.dedupe_first(deduped, ["order_line_id"], order).collect()), key=repr)
    spread = c.dedupe_first(df.repartition(5), ["order_line_id"], order)
    assert once == again == sorted(map(tuple, spread.collect()), key=repr)


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = c.dedupe_first(orders(spark, {}), ["order_line_id"])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("Partial") > physical.index("Exchange")


def test_replays(spark):
    df = orders(spark, {}, {})
    again = c.with_replays(df, df.filter("order_line_id = 2"))
    assert ids(again) == [1, 2, 2]
    assert ids(c.dedupe_first(again, ["order_line_id"])) == [1, 2]
    assert DAY == again.first().order_date


def test_only_rows_with_repeated_keys_are_shuffled(spark, tmp_path):
    rows = [(k, k % 3, f"v{k % 5}") for k in range(200)] + [(7, 9, "a"), (7, 1, "b"), (None, 1, "x")]
    rows += [(None, 0, "y"), (11, 0, None)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "k long, x int, v string").repartition(5).write.parquet(path)
    stored = spark.read.parquet(path)
    want = sorted(map(repr, c.dedupe_first(stored, ["k"], ["x"]).collect()))
    found = c.dedupe_in_place(stored, ["k"], ["x"])
    assert sorted(map(repr, found.collect())) == want
    everything = c.dedupe_in_place(stored, ["k"], ["x"], most=1)
    assert sorted(map(repr, everything.collect())) == want


def test_in_place_dedupe_has_one_exchange_behind_the_filter(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).selectExpr("id % 990 AS k", "id AS x").write.parquet(path)
    found = c.dedupe_in_place(spark.read.parquet(path), ["k"], ["x"])
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "Union" in plan
    assert found.count() == 990
    executed = found._jdf.queryExecution().executedPlan().toString()
    # rows go through an exchange only after the filter on repeated hashes
    for part in executed.split("Exchange hashpartitioning")[1:]:
        assert "_twice" in part
