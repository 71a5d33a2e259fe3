import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stockweave.functions.order_stats import Rank, locate, percentile
from stockweave.operators.ranking import global_ntile


def _expected(df, n):
    a = Window.orderBy(F.asc_nulls_first("v"), F.asc_nulls_first("id"))
    d = Window.orderBy(F.desc_nulls_last("v"), F.asc_nulls_first("id"))
    return df.select(
        "id", "v", F.ntile(n).over(a).alias("up"), F.ntile(n).over(d).alias("down")
    )


def _check(spark, values, n=5):
    df = spark.createDataFrame(list(enumerate(values)), "id long, v long")
    # for the descending order nulls come last, so they need the highest negated key
    got = global_ntile(df, n, {"up": F.col("v")}, "id").select("id", "v", "up")
    down = global_ntile(
        df.filter("v IS NOT NULL"), n, {"down": -F.col("v")}, "id"
    ).select("id", "v", "down")
    want = _expected(df, n)
    assert sorted(got.collect()) == sorted(want.select("id", "v", "up").collect())
    want_down = _expected(df.filter("v IS NOT NULL"), n)
    assert sorted(down.collect()) == sorted(want_down.select("id", "v", "down").collect())


@pytest.mark.parametrize("rows", [1, 2, 3, 4, 5, 7, 23, 101])
def test_few_rows(spark, rows):
    random.seed(rows)
    _check(spark, [random.randint(-3, 3) for _ in range(rows)])


def test_one_value_holds_most_rows(spark):
    _check(spark, [1] * 400 + list(range(2, 60)))


def test_wide_range_needs_several_rounds(spark):
    random.seed(1)
    _check(spark, [random.randint(-(2**55), 2**55) for _ in range(200)])


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.integers(1, 7))
def test_equals_ntile(spark, values, n):
    _check(spark, values, n)


def test_nulls_sort_lowest(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None), (4, 1)], "id long, v long")
    got = {r.id: r.q for r in global_ntile(df, 4, {"q": F.col("v")}, "id").collect()}
    assert got == {1: 1, 3: 2, 4: 3, 2: 4}


def test_empty(spark):
    df = spark.createDataFrame([], "id long, v long")
    assert global_ntile(df, 5, {"q": F.col("v")}, "id").count() == 0


def test_locate_counts_rows_below(spark):
    df = spark.createDataFrame([(v,) for v in [1, 5, 5, 5, 9]], "k long")
    found = locate(df, [Rank("k", r, 0, 10**12) for r in (1, 3, 5)], bins=16)
    assert [(r.low, r.below) for r in found] == [(1, 0), (5, 1), (9, 4)]


def test_percentile_interpolates(spark):
    df = spark.createDataFrame([(v,) for v in [0, 10, 20, 30]], "k long")
    assert percentile(df, "k", 0.5, 4, 0, 100) == 15
    assert percentile(df, "k", 1.0, 4, 0, 100) == 30


def test_no_row_is_moved_to_one_task(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    plan = global_ntile(df, 5, {"q": F.col("v")}, "id")._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
