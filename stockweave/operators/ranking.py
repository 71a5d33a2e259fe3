"""NTILE over a whole table and bounded heads of groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.functions.order_stats import Rank, locate


def global_ntile(
    df: DataFrame,
    n: int,
    orderings: Mapping[str, Column],
    tiebreak: str,
) -> DataFrame:
    """Add one `NTILE(n)` column per ordering, over all rows of `df`.

    `orderings` maps an output column to an ascending integral sort key (negate it for
    a descending order); nulls sort lowest. `tiebreak` is an integral column that makes
    the order total. An unpartitioned window would move the table to one task; only the
    n - 1 border rows of each ordering matter, so they are located by counting and
    every row is compared with them as literals: no shuffle and no sort of the rows.
    """
    keys = {out: f"_key_{i}" for i, out in enumerate(orderings)}
    names = [*keys.values(), "_tie"]
    kept = df.columns
    keyed = durable(
        df.select(
            "*",
            *[expr.cast("long").alias(keys[out]) for out, expr in orderings.items()],
            F.col(tiebreak).cast("long").alias("_tie"),
        ),
        "ntile",
    )
    stats = keyed.agg(
        F.count("*").alias("rows"),
        *[F.min(k).alias(f"min{k}") for k in names],
        *[F.max(k).alias(f"max{k}") for k in names],
    ).first()
    rows = stats["rows"]
    if rows == 0:
        return keyed.select(*kept, *[F.lit(None).cast("int").alias(out) for out in orderings])

    low = {k: (stats[f"min{k}"] or 0) - 1 for k in names}  # one below the minimum stands for null
    high = {k: stats[f"max{k}"] if stats[f"max{k}"] is not None else low[k] for k in names}
    dense = keyed.select(
        *kept, *[F.coalesce(F.col(k), F.lit(low[k]).cast("long")).alias(k) for k in names]
    )

    size, extra = divmod(rows, n)
    ends = [j * size + min(j, extra) for j in range(1, n)]  # last row of each bucket but the final
    by_value = {
        (out, j): Rank(k, end, low[k], high[k])
        for out, k in keys.items()
        for j, end in enumerate(ends)
    }
    locate(dense, list(by_value.values()))
    by_tie = {
        (out, j): Rank(
            "_tie",
            r.rank - r.below,
            low["_tie"],
            high["_tie"],
            where=F.col(r.key) == r.low,
            scope=f"{r.key}={r.low}",
        )
        for (out, j), r in by_value.items()
    }
    locate(dense, list(by_tie.values()))

    def bucket(out: str) -> Column:
        value = F.col(keys[out])
        after = [
            (value > by_value[out, j].low)
            | ((value == by_value[out, j].low) & (F.col("_tie") > by_tie[out, j].low))
            for j in range(n - 1)
        ]
        return sum((c.cast("int") for c in after), F.lit(1))

    return dense.select(*kept, *[bucket(out).alias(out) for out in orderings])


def head_of_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """First `n` rows of every group. Spark trims each group to `n` rows before the shuffle
    as well as after it, so a large group never travels whole. It does so for `n` up to
    `spark.sql.optimizer.windowGroupLimitThreshold` (1000)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= n).drop("_at")
