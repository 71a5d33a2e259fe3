"""Cleaning rules for orders, customers, products and inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.durable import durable
from stockweave.operators.ranking import head_of_groups
from stockweave.schemas import MONEY, PRICE

UNKNOWN_EMAIL = "unknown@example.com"
ORDER_KEY = "order_line_id"

MOST_REPEATED = 1 << 21  # 64-bit hashes sent to all tasks

MISSING_CUSTOMER = "missing_customer"
NON_POSITIVE_QUANTITY = "non_positive_quantity"
NON_POSITIVE_TOTAL = "non_positive_total"


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of every key; nulls are equal as keys and sort first.

    `order` says what "first" means; the remaining columns break its ties, so the result
    does not depend on how the rows are spread. Copies are dropped before the shuffle as
    well as after it: a key repeated a billion times sends one row per task.
    """
    ranked = [*order, *(c for c in df.columns if c not in order and c not in keys)]
    if not ranked:
        return df.distinct()
    return head_of_groups(df, keys, [F.col(c) for c in ranked], 1)


def dedupe_in_place(
    stored: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] = (),
    most: int = MOST_REPEATED,
) -> DataFrame:
    """As `dedupe_first`, but rows whose key has no copy stay in the task that reads them.

    A first pass counts 64-bit hashes of the keys, 8 bytes each instead of whole rows. Hashes that
    occur twice go to all tasks if there are at most `most`; only rows with one of them
    are shuffled, and compared by their whole keys, so a hash that two keys share does no harm.
    With more repeats than that nearly all rows would move anyway: then all of them do. `stored` is
    read twice more, so it should be a table and not the result of costly work.
    """
    hashed = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    repeated = durable(
        stored.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_rows"))
        .filter("_rows > 1").select("_hash", F.lit(True).alias("_twice")),
        "repeated-keys",
    )
    if repeated.count() > most:
        return dedupe_first(stored, keys, order)
    marked = stored.withColumn("_hash", hashed).join(F.broadcast(repeated), "_hash", "left")
    alone = marked.filter(F.col("_twice").isNull()).drop("_hash", "_twice")
    several = marked.filter(F.col("_twice")).drop("_hash", "_twice")
    return alone.unionByName(dedupe_first(several, keys, order))


def split_null_key(df: DataFrame, key: str = "customer_id") -> tuple[DataFrame, DataFrame]:
    """(rows with the key, rows to quarantine)."""
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def reject_quantity(df: DataFrame) -> DataFrame:
    """Null quantities fail the comparison and go too."""
    return df.filter(F.col("quantity") > 0)


def reject_total(df: DataFrame) -> DataFrame:
    return df.filter(F.col("total_amount") > 0)


def parse_dates(
    df: DataFrame,
    strict: Sequence[str] = ("order_date", "delivery_date"),
    lenient: Sequence[str] = ("ship_date",),
) -> DataFrame:
    """Text to dates: bad text raises in `strict` columns and becomes null in `lenient` ones."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("date") for c in strict},
            **{c: F.expr(f"try_cast(`{c}` AS date)") for c in lenient},
        }
    )


def normalise_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "customer_id": F.col("customer_id").cast("long"),
            "quantity": F.col("quantity").cast("int"),
            "unit_price": F.col("unit_price").cast(PRICE),
            "total_amount": F.col("total_amount").cast(MONEY),
        }
    )


def reject_reason() -> Column:
    """Rule that removes a deduplicated order line, null for a line that passes.

    The rules apply in sequence, so the first one that fails is the reason.
    """
    return (
        F.when(F.col("customer_id").isNull(), MISSING_CUSTOMER)
        .when(~F.coalesce(F.col("quantity") > 0, F.lit(False)), NON_POSITIVE_QUANTITY)
        .when(~F.coalesce(F.col("total_amount") > 0, F.lit(False)), NON_POSITIVE_TOTAL)
    )


def classify_orders(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Deduplicated orders with the `reject_reason` of each: the shared input of the clean
    table, the quarantine and the counts. Duplicates go first, so a key whose first copy
    is bad disappears altogether."""
    return dedupe_first(df, [ORDER_KEY], order).withColumn("reject_reason", reject_reason())


def accepted(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(classified: DataFrame, reason: str) -> DataFrame:
    return classified.filter(F.col("reject_reason") == reason).drop("reject_reason")


def clean_orders(df: DataFrame, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(clean orders, quarantined orders) under all six rules."""
    classified = classify_orders(df, order)
    return (
        normalise_types(parse_dates(accepted(classified))),
        rejected(classified, MISSING_CUSTOMER),
    )


def silver_orders(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """The row rules only: no quarantine, no date parsing and no rounding."""
    clean = accepted(classify_orders(df, order))
    return clean.withColumn("customer_id", F.col("customer_id").cast("long"))


def clean_customers(
    df: DataFrame, unknown_email: str = UNKNOWN_EMAIL, parse: bool = True
) -> DataFrame:
    fixed = df.withColumn("email", F.coalesce("email", F.lit(unknown_email)))
    return parse_dates(fixed, ["registration_date"], []) if parse else fixed


def clean_products(df: DataFrame) -> DataFrame:
    return df.withColumn("cost_price", F.coalesce("cost_price", F.lit(0).cast(MONEY)))


def clean_inventory(df: DataFrame) -> DataFrame:
    return df.withColumn("quantity_on_hand", F.coalesce("quantity_on_hand", F.lit(0)))


def classify_counted(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """As `classify_orders`, with `copies`: how many rows an order line has.

    The smallest struct in the order of `dedupe_first` is the first copy: one partial
    aggregation instead of a sort, and no second scan for the count.
    """
    rest = [c for c in df.columns if c not in order and c != ORDER_KEY]
    first = df.groupBy(ORDER_KEY).agg(
        F.min(F.struct(*order, *rest)).alias("first"), F.count("*").alias("copies")
    )
    return first.select(
        *[F.col(c) if c == ORDER_KEY else F.col(f"first.{c}") for c in df.columns], "copies"
    ).withColumn("reject_reason", reject_reason())


def _long_form(counts: DataFrame, table: str) -> DataFrame:
    return counts.unpivot([], counts.columns, "measure", "row_count").select(
        F.lit(table).alias("table_name"), "measure", F.col("row_count").cast("long")
    )


def cleaning_report(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    inventory: DataFrame,
    order: Sequence[str] = (),
) -> DataFrame:
    """Audit counts: one pass per table, whatever the number of rules.

    The number of copies is counted along with the first copy of each order line.
    """
    return audit_report(classify_counted(orders, order), customers, products, inventory)


def audit_report(
    classified: DataFrame, customers: DataFrame, products: DataFrame, inventory: DataFrame
) -> DataFrame:
    """Audit counts of orders that `classify_counted` gave, so that a run that stored them
    counts what it stored and doesn't look at the raw orders again."""
    reason = F.col("reject_reason")
    order_counts = classified.agg(
        F.count("*").alias("after_dedupe"),
        F.count_if(reason == MISSING_CUSTOMER).alias("quarantined_no_customer"),
        # null quantities and totals are dropped but were never counted as negative
        F.count_if((reason == NON_POSITIVE_QUANTITY) & F.col("quantity").isNotNull()).alias(
            "negative_quantity"
        ),
        F.count_if((reason == NON_POSITIVE_TOTAL) & F.col("total_amount").isNotNull()).alias(
            "negative_total"
        ),
        F.count_if(reason.isNull()).alias("clean"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("start"),
    ).withColumn("removed", F.col("start") - F.col("clean"))

    def fixed(df: DataFrame, column: str, label: str) -> DataFrame:
        return df.agg(
            F.count_if(F.col(column).isNull()).alias(label), F.count("*").alias("clean")
        )

    return (
        _long_form(order_counts, "orders")
        .unionByName(_long_form(fixed(customers, "email", "null_emails_fixed"), "customers"))
        .unionByName(_long_form(fixed(products, "cost_price", "null_costs_fixed"), "products"))
        .unionByName(
            _long_form(fixed(inventory, "quantity_on_hand", "null_quantities_fixed"), "inventory")
        )
    )


def with_replays(df: DataFrame, rows: DataFrame) -> DataFrame:
    """The feed with some rows sent again."""
    return df.unionByName(rows)
