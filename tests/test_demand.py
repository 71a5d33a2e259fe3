import datetime as dt

import pytest

from helpers import orders
from stockweave.operators import demand as d
from stockweave.operators import evaluation as e


def month_orders(spark, key, months):
    return [
        {"product_id": key, "order_date": dt.date(y, m, 15), "quantity": q} for y, m, q in months
    ]


@pytest.fixture(scope="module")
def history(spark):
    rows = (
        month_orders(spark, 1, [(2023, 11, 10), (2023, 12, 20), (2024, 2, 30), (2024, 3, 40), (2024, 4, 50)])
        + month_orders(spark, 2, [(2024, 1, 1), (2024, 2, 2), (2024, 3, 3)])
        + month_orders(spark, 3, [(2024, 1, 9)])
    )
    rows += [{"product_id": 1, "order_date": dt.date(2024, 4, 20), "order_status": "Cancelled"}]
    return orders(spark, *rows)


def test_lags_follow_observed_months(history):
    cells = d.add_rolling(d.add_lags(d.demand_cells(history)))
    got = [
        (r.year, r.month, r.total_quantity, r.lag_1_qty, r.lag_2_qty, r.lag_3_qty, r.rolling_3m_avg)
        for r in cells.filter("product_id = 1").orderBy("year", "month").collect()
    ]
    assert got == [
        (2023, 11, 10, None, None, None, None),
        (2023, 12, 20, 10, None, None, None),
        (2024, 2, 30, 20, 10, None, None),
        (2024, 3, 40, 30, 20, 10, 20.0),
        (2024, 4, 50, 40, 30, 20, 30.0),
    ]


def test_features_need_three_months_of_history(history):
    rows = d.demand_features(history).orderBy("month").collect()
    assert [(r.product_id, r.month, r.season, r.season_num) for r in rows] == [
        (1, 3, "Spring", 1), (1, 4, "Spring", 1),
    ]


def test_one_window_sort(history):
    plan = d.demand_features(history)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("\n") and plan.count("Window [") == 1


def test_forecast_rows_round_half_even(spark):
    df = spark.createDataFrame(
        [(1, 1, 2024, 2, 2.5), (1, 1, 2024, 3, 3.5)],
        "product_id long, warehouse_id long, year int, month int, p double",
    )
    rows = d.forecast_rows(df, df.p, "m").orderBy("forecast_date").collect()
    assert [(r.forecast_date, r.predicted_demand) for r in rows] == [
        (dt.date(2024, 2, 1), 2.0), (dt.date(2024, 3, 1), 4.0),
    ]


def test_metrics(spark):
    df = spark.createDataFrame([(20, 10.0), (10, 13.0), (0, 1.0)], "a long, p double")
    row = e.forecast_metrics(df, "a", "p").first()
    assert (row.row_count, row.mae, row.mape, row.passed) == (3, 14 / 3, 50.0, True)
    small = e.forecast_metrics(df.filter("a <= 10"), "a", "p").first()
    assert small.mape == 999.0
    hit = e.accuracy(df.selectExpr("1 AS y", "CASE WHEN a > 5 THEN 1 ELSE 0 END AS z"), "y", "z").first()
    assert hit.accuracy == 2 / 3 and hit.passed


def test_split_is_stable_and_near_a_fifth(spark):
    df = spark.range(5000)
    test = {r.id for r in e.hash_split(df, ["id"]).filter("is_test").collect()}
    again = {r.id for r in e.hash_split(df.repartition(7), ["id"]).filter("is_test").collect()}
    assert test == again and 0.17 < len(test) / 5000 < 0.23
