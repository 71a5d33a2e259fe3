import math
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import inventory, products
from stockweave.operators import inventory as stock_transfers
from stockweave.operators.inventory import inventory_rebalancing, leading_pairs, transfer_sides


def brute_force(stock, costs, limit):
    sides = {"over": [], "under": []}
    for product, warehouse, on_hand, reorder in stock:
        if on_hand is None or product not in costs:
            continue
        if on_hand > 2 * reorder:
            sides["over"].append((product, warehouse, on_hand - reorder))
        elif on_hand < reorder:
            sides["under"].append((product, warehouse, reorder - on_hand))
    found = []
    for p, source, excess in sides["over"]:
        for q, dest, needed in sides["under"]:
            if p == q and source != dest:
                units = min(excess, needed)
                cost = costs[p]
                savings = None if cost is None else units * cost
                priority = "High" if needed > 100 else "Medium" if needed > 50 else "Low"
                rank = (savings is None, -(savings or 0), p, source, dest, -units, -needed)
                found.append((rank, (p, source, dest, units, savings, priority)))
    found.sort(key=lambda f: f[0])
    return [row for _, row in found[:limit]]


def run(spark, stock, costs, limit):
    inv = inventory(
        spark,
        *[
            dict(product_id=p, warehouse_id=w, quantity_on_hand=q, reorder_point=r)
            for p, w, q, r in stock
        ],
    )
    dim = products(spark, *[dict(product_id=p, cost_price=c) for p, c in costs.items()])
    return [tuple(r) for r in inventory_rebalancing(inv, dim, limit).collect()]


def check(spark, stock, costs, limit):
    assert run(spark, stock, costs, limit) == brute_force(stock, costs, limit)


def test_sides(spark):
    inv = inventory(
        spark,
        *[dict(warehouse_id=i, quantity_on_hand=q) for i, q in enumerate([10, 20, 21, 9, 0, None])],
    )
    got = {r.warehouse_id: (r.side, r.units) for r in transfer_sides(inv).collect()}
    assert got == {2: ("over", 11), 3: ("under", 1), 4: ("under", 10)}


@pytest.mark.parametrize("needed,priority", [(50, "Low"), (51, "Medium"), (100, "Medium"), (101, "High")])
def test_priority(spark, needed, priority):
    stock = [(1, 1, 1000, 10), (1, 2, 0, needed)]
    assert run(spark, stock, {1: Decimal("2.50")}, 5) == [
        (1, 1, 2, needed, needed * Decimal("2.50"), priority)
    ]


def test_tasks_that_group_all_rows_stay_small(spark, monkeypatch):
    """More rows make more tasks, not larger ones."""
    monkeypatch.setattr(stock_transfers, "ROWS_PER_TASK", 50, raising=False)
    held, best = [], stock_transfers._best_transfer

    def counting(sides):
        by_task = sides.groupBy(F.spark_partition_id()).count().collect()
        held.extend(r["count"] for r in by_task)
        return best(sides)

    monkeypatch.setattr(stock_transfers, "_best_transfer", counting)
    stock = [(p, w, 500 if w % 2 else 3, 20 + w % 7) for p in range(40) for w in range(20)]
    costs = {p: Decimal(p + 1) for p in range(40)}
    names = ("product_id", "warehouse_id", "quantity_on_hand", "reorder_point")
    inv = inventory(spark, *[dict(zip(names, row, strict=True)) for row in stock]).coalesce(1)
    dim = products(spark, *[dict(product_id=p, cost_price=c) for p, c in costs.items()])
    got = [tuple(r) for r in inventory_rebalancing(inv, dim, 30).collect()]
    assert got == brute_force(stock, costs, 30)
    assert sum(held) == 800 and max(held) <= 200


def test_hot_product_with_ties(spark):
    stock = [(1, w, 500, 20) for w in range(60)] + [(1, 100 + w, 0, 40) for w in range(60)]
    stock += [(2, 1, 90, 10), (2, 2, 0, 70)]
    check(spark, stock, {1: Decimal("1.00"), 2: Decimal("0.50")}, 7)


def test_zero_and_missing_costs_come_last(spark):
    stock = [(p, 1, 100, 10) for p in (1, 2, 3)] + [(p, w, 1, 10) for p in (1, 2, 3) for w in (2, 3)]
    check(spark, stock, {1: None, 2: Decimal("0.00"), 3: Decimal("4.00")}, 5)
    check(spark, stock, {1: None, 2: Decimal("0.00"), 3: Decimal("4.00")}, 100)


def test_several_snapshots_never_pair_a_warehouse_with_itself(spark):
    stock = [(1, 5, 100 + i, 10) for i in range(12)] + [(1, 5, 0, 90 + i) for i in range(12)]
    assert run(spark, stock, {1: Decimal("1.00")}, 3) == []
    stock += [(1, 6, 30, 10), (1, 7, 0, 5)]
    check(spark, stock, {1: Decimal("1.00")}, 4)


def test_negative_costs_come_after_zero_and_before_missing(spark):
    stock = [(p, 1, 100, 10) for p in (1, 2, 3)] + [(p, w, 1, 10 + w) for p in (1, 2, 3) for w in (2, 3)]
    costs = {1: None, 2: Decimal("-1.00"), 3: Decimal("0.00")}
    check(spark, stock, costs, 5)
    assert [r[0] for r in run(spark, stock, costs, 10)] == [3, 3, 2, 2, 1, 1]


def test_limit_is_positive(spark):
    with pytest.raises(ValueError):
        run(spark, [(1, 1, 100, 10)], {1: Decimal("1.00")}, 0)


def test_few_pairs_are_formed(spark):
    """One product with 400 sources and 400 destinations has 160,000 transfers."""
    stock = [(1, w, 500 + w, 20) for w in range(400)] + [(1, 1000 + w, 0, 40 + w) for w in range(400)]
    inv = inventory(
        spark,
        *[dict(product_id=p, warehouse_id=w, quantity_on_hand=q, reorder_point=r) for p, w, q, r in stock],
    )
    sides = transfer_sides(inv).withColumn("cost_price", F.lit(Decimal("1.00")))
    for limit in (100, 400):
        assert leading_pairs(sides, limit).count() < limit * (math.log(limit) + 6)
    check(spark, stock, {1: Decimal("1.00")}, 150)


_ROW = st.tuples(
    st.integers(1, 3), st.integers(1, 5), st.one_of(st.none(), st.integers(0, 60)), st.integers(5, 40)
)
_COST = st.sampled_from([None, Decimal("-3.00"), Decimal("0.00"), Decimal("1.00"), Decimal("2.00"), Decimal("7.25")])


@settings(max_examples=12, deadline=None)
@given(
    st.lists(_ROW, min_size=1, max_size=45),
    st.dictionaries(st.integers(1, 3), _COST, min_size=1),
    st.integers(1, 6),
)
def test_equals_brute_force(spark, stock, costs, limit):
    check(spark, stock, costs, limit)
