"""Stock transfers from overstocked to understocked warehouses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.functions.scalar import stock_status, transfer_priority
from stockweave.operators.ranking import head_of_groups

_AMOUNT = "decimal(28,2)"
ROWS_PER_TASK = 1 << 19  # of the tasks that group all rows by warehouse


def _unpriced() -> Column:
    """Savings of a product without a cost: ranks after every real amount."""
    return F.lit("-99999999999999999999.00").cast(_AMOUNT)


def _worth(units: Column) -> Column:
    return F.coalesce((units * F.col("cost_price")).cast(_AMOUNT), _unpriced())


def transfer_sides(inventory: DataFrame) -> DataFrame:
    """Rows that can give (`over`, units above the reorder point) or take (`under`, units
    below it). Rows without a count, and normally stocked rows, take no part."""
    on_hand, reorder = F.col("quantity_on_hand"), F.col("reorder_point")
    status = stock_status(on_hand, reorder)
    return (
        inventory.filter(on_hand.isNotNull())
        .select(
            "product_id",
            "warehouse_id",
            F.when(status == "Overstocked", "over")
            .when(status == "Understocked", "under")
            .alias("side"),
            F.when(status == "Overstocked", on_hand - reorder)
            .otherwise(reorder - on_hand)
            .alias("units"),
        )
        .filter(F.col("side").isNotNull())
    )


def _spread(sides: DataFrame) -> DataFrame:
    """`sides` dealt by product and warehouse to tasks of ROWS_PER_TASK rows on average.

    Adaptive execution would merge them into as few tasks as there are cores, and what these
    group and sort in memory would grow with the table.
    """
    tasks = max(1, -(-sides.count() // ROWS_PER_TASK))
    return sides.repartition(tasks, "product_id", "warehouse_id")


def _best_transfer(sides: DataFrame) -> DataFrame:
    """Largest transferable quantity of every product that has a transfer at all.

    The two best warehouses of each side settle it: only the pair of a warehouse with
    itself is excluded.
    """
    per_warehouse = sides.groupBy("product_id", "side", "warehouse_id").agg(
        F.max("units").alias("units")
    )
    largest = [F.desc("units"), F.col("warehouse_id")]
    second = head_of_groups(per_warehouse, ["product_id", "side"], largest, 2)
    ends = F.struct("units", "warehouse_id")
    best = second.groupBy("product_id").agg(
        *[
            pick(F.when(F.col("side") == side, ends)).alias(f"{side}_{rank}")
            for side in ("over", "under")
            for rank, pick in (("first", F.max), ("last", F.min))
        ]
    )

    def pair(a: str, b: str) -> Column:
        apart = F.col(f"{a}.warehouse_id") != F.col(f"{b}.warehouse_id")
        return F.when(apart, F.least(F.col(f"{a}.units"), F.col(f"{b}.units")))

    quantity = F.greatest(
        *[pair(f"over_{i}", f"under_{j}") for i in ("first", "last") for j in ("first", "last")]
    )
    return best.select("product_id", quantity.alias("units")).filter(F.col("units").isNotNull())


def _head_by_warehouse(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], limit: int
) -> DataFrame:
    """Head of each group that still holds `limit` rows outside any single warehouse."""
    one = head_of_groups(df, [*group, "warehouse_id"], [F.desc("units")], limit)
    return head_of_groups(one, group, order, 2 * limit)


def _source(sides: DataFrame, *more: str | Column) -> DataFrame:
    return sides.filter(F.col("side") == "over").select(
        "product_id",
        F.col("warehouse_id").alias("source_warehouse_id"),
        F.col("units").alias("excess"),
        *more,
    )


def _destination(sides: DataFrame, *more: str | Column) -> DataFrame:
    return sides.filter(F.col("side") == "under").select(
        "product_id",
        "cost_price",
        F.col("warehouse_id").alias("dest_warehouse_id"),
        F.col("units").alias("needed"),
        *more,
    )


def _transfers(pairs: DataFrame) -> DataFrame:
    """Pairs of different warehouses, with what moves and what it is worth."""
    quantity = F.least("excess", "needed")
    return (
        pairs.filter(F.col("source_warehouse_id") != F.col("dest_warehouse_id"))
        .withColumn("recommended_qty", quantity)
        .withColumn("worth", _worth(quantity))
        .select(
            "product_id",
            "cost_price",
            "source_warehouse_id",
            "dest_warehouse_id",
            "recommended_qty",
            "needed",
            "worth",
        )
    )


def _leaders(best: DataFrame, costs: DataFrame, limit: int) -> DataFrame:
    """The `limit` products whose best transfer (product, units) is worth most."""
    return (
        best.join(costs, "product_id")
        .select("product_id", "cost_price", _worth(F.col("units")).alias("best"))
        .orderBy(F.desc("best"), "product_id")
        .limit(limit)
        .drop("best")
    )


def leading_pairs(richest: DataFrame, limit: int) -> DataFrame:
    """Pairs among which the `limit` best transfers of every product are found.

    Rows are numbered by size: i is how many warehouses have shown up on a side so far. A pair
    numbered (i, j) has i * j - min(i, j) pairs at least as good, one for each two different
    warehouses before it. So for a source i only destinations up to limit / (i - 1) matter,
    in all about limit * log(limit) pairs.
    """
    side = Window.partitionBy("product_id", "side")
    largest = [F.desc("units"), F.col("warehouse_id")]
    first = F.row_number().over(
        Window.partitionBy("product_id", "side", "warehouse_id").orderBy(F.desc("units"))
    )
    numbered = richest.withColumn("first", (first == 1).cast("int")).withColumn(
        "number", F.sum("first").over(side.orderBy(*largest, F.desc("first")).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        ))
    )
    last = F.ceil(F.lit(limit) / F.greatest(F.lit(1), F.col("number") - 1))
    over = _source(numbered, "number").withColumn(
        "number", F.explode(F.sequence(F.lit(1).cast("long"), last.cast("long")))
    )
    return _transfers(over.join(_destination(numbered, "number"), ["product_id", "number"]))


def _tied(classed: DataFrame, limit: int) -> DataFrame:
    """Transfers worth exactly the floor, enough of them in the order they are listed.

    A transfer ties if one side is at the floor and the other is not below it. Sources are
    taken by warehouse id until they have `limit` transfers together, and each gets as many
    destinations by warehouse id as are still needed.
    """
    over = _source(classed, "above")
    under = _destination(classed, "above")
    totals = under.groupBy("product_id").agg(
        F.count("*").alias("all"), F.count_if(~F.col("above")).alias("at")
    )
    own = under.groupBy("product_id", F.col("dest_warehouse_id").alias("source_warehouse_id")).agg(
        F.count("*").alias("own_all"), F.count_if(~F.col("above")).alias("own_at")
    )
    counted = (
        over.join(totals, "product_id")
        .join(own, ["product_id", "source_warehouse_id"], "left")
        .withColumn("own", F.when(F.col("above"), F.col("own_at")).otherwise(F.col("own_all")))
        .withColumn("own", F.coalesce("own", F.lit(0)))
        .withColumn("partners", F.when(F.col("above"), F.col("at")).otherwise(F.col("all")))
        .withColumn("partners", F.col("partners") - F.col("own"))
        .filter("partners > 0")
    )
    earlier = (
        Window.partitionBy("product_id")
        .orderBy("source_warehouse_id")
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    wanted = F.least(F.col("partners"), F.lit(limit) - F.col("before")) + F.col("own")
    sources = (
        counted.withColumn("before", F.coalesce(F.sum("partners").over(earlier), F.lit(0)))
        .filter(F.col("before") < limit)
        .withColumn("place", F.explode(F.sequence(F.lit(1).cast("long"), wanted.cast("long"))))
        .select("product_id", "source_warehouse_id", "excess", "above", "place")
    )
    by_id = Window.partitionBy("product_id").orderBy("dest_warehouse_id", F.desc("needed"))
    every = under.withColumn("place", F.row_number().over(by_id).cast("long")).drop("above")
    at = (
        under.filter(~F.col("above"))
        .withColumn("place", F.row_number().over(by_id).cast("long"))
        .drop("above")
    )
    keys = ["product_id", "place"]
    pairs = sources.filter(~F.col("above")).join(every, keys).unionByName(
        sources.filter("above").join(at, keys)
    )
    return _transfers(pairs)


def _best_transfers(sides: DataFrame, costs: DataFrame, limit: int) -> DataFrame:
    """The `limit` best transfers of products whose cost is not negative, and a few others."""
    leaders = _leaders(_best_transfer(_spread(sides)), costs, limit)
    # what the leaders select is small as a rule and is read several times
    pool = durable(
        sides.join(F.broadcast(leaders), "product_id").withColumn("worth", _worth(F.col("units"))), "transfers"
    )
    by_size = [F.desc("units"), F.col("warehouse_id")]
    richest = _head_by_warehouse(pool, ["product_id", "side"], by_size, limit)
    last = (
        leading_pairs(richest.drop("worth"), limit)
        .select("worth")
        .orderBy(F.desc("worth"))
        .limit(limit)
        .agg(
            # fewer transfers than `limit`: nothing may be left out
            F.when(F.count("*") == limit, F.min("worth")).alias("worth")
        )
    )
    # below every worth there is: everything is above it
    floor = F.coalesce(last.scalar(), _unpriced() - 1)
    classed = pool.filter(F.col("worth") >= floor).withColumn("above", F.col("worth") > floor)
    by_id = [F.col("warehouse_id"), F.desc("units")]
    short = durable(
        _head_by_warehouse(classed, ["product_id", "side", "above"], by_id, limit).drop("worth"),
        "tied-transfers",
    )
    above = short.filter("above")  # fewer than `limit` pairs
    return _transfers(
        _source(above).join(_destination(above), "product_id")
    ).unionByName(_tied(short, limit))


def _worst_transfers(sides: DataFrame, costs: DataFrame, limit: int) -> DataFrame:
    """The same for products with a negative cost: the less moves the better.

    Of two sides, the smaller one sets the quantity. It is among the smallest of its side, as
    each smaller one has a better transfer with the same partner; the partner is among the
    lowest warehouse ids, as every lower one gives a transfer as good or better.
    """
    smallest = [F.col("units"), F.col("warehouse_id")]
    by_id = [F.col("warehouse_id"), F.desc("units")]
    per_warehouse = _spread(sides).groupBy("product_id", "side", "warehouse_id").agg(
        F.min("units").alias("units")
    )
    ends = head_of_groups(per_warehouse, ["product_id", "side"], smallest, 2)
    over, under = (
        ends.filter(F.col("side") == side).select(
            "product_id", F.col("warehouse_id").alias(f"{side}_id"), F.col("units").alias(side)
        )
        for side in ("over", "under")
    )
    least = (
        over.join(under, "product_id")
        .filter(F.col("over_id") != F.col("under_id"))
        .groupBy("product_id")
        .agg(F.min(F.least("over", "under")).alias("units"))
    )
    pool = durable(
        sides.join(F.broadcast(_leaders(least, costs, limit)), "product_id").withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "costly-transfers",
    )

    def head(order: list[Column]) -> DataFrame:
        one = head_of_groups(pool, ["product_id", "side", "warehouse_id"], order, limit + 1)
        return head_of_groups(one, ["product_id", "side"], order, 2 * (limit + 1))

    def pairs(sources: DataFrame, destinations: DataFrame) -> DataFrame:
        return _source(sources, F.col("row").alias("source_row")).join(
            _destination(destinations, F.col("row").alias("dest_row")), "product_id"
        )

    small, low = head(smallest), head(by_id)
    both = pairs(small, low).unionByName(pairs(low, small))
    return _transfers(both.dropDuplicates(["source_row", "dest_row"]))


def inventory_rebalancing(
    inventory: DataFrame, products: DataFrame, limit: int = 100
) -> DataFrame:
    """The `limit` transfers that save most: product, source, destination, quantity, savings.

    Every surplus is offered to every needy warehouse of the product, so a product with
    many rows has quadratically many transfers. They are never listed. A transfer is worth
    min(excess, need) x cost, hence:

    1. only the `limit` products with the best single transfer can appear in the result;
    2. within them the largest surpluses and needs fix the value of the last transfer listed
       (`leading_pairs`);
    3. fewer than `limit` transfers are worth more; of those worth the same only as many are
       formed as can be listed.

    About limit x log(limit) pairs are formed per product, and the result is exact. Ties are
    listed by product, source and destination. Products with a negative cost lose by every
    transfer and so come after the others, and products without a cost come last.
    """
    if limit < 1:
        raise ValueError("limit must be at least 1")
    sides = durable(transfer_sides(inventory), "transfer-sides")  # read four times
    costs = products.select("product_id", "cost_price")
    negative = F.coalesce(F.col("cost_price") < 0, F.lit(False))
    found = _best_transfers(sides, costs.filter(~negative), limit).unionByName(
        _worst_transfers(sides, costs.filter(negative), limit)
    )
    return (
        found.orderBy(
            F.desc("worth"),
            "product_id",
            "source_warehouse_id",
            "dest_warehouse_id",
            F.desc("recommended_qty"),
            F.desc("needed"),
        )
        .limit(limit)
        .select(
            "product_id",
            "source_warehouse_id",
            "dest_warehouse_id",
            "recommended_qty",
            F.round(F.col("recommended_qty") * F.col("cost_price"), 2)
            .cast(_AMOUNT)
            .alias("estimated_savings"),
            transfer_priority(F.col("needed")).alias("priority"),
        )
    )
