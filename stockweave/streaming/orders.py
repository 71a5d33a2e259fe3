"""The order feed as Structured Streaming: decode, count, clean."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from stockweave.durable import scratch_copy
from stockweave.operators.cleaning import (
    MISSING_CUSTOMER,
    ORDER_KEY,
    accepted,
    normalise_types,
    reject_reason,
    rejected,
)
from stockweave.schemas import ORDERS
from stockweave.session import usually

MALFORMED = "malformed"
BAD_DATE = "bad_date"
STRICT_DATES = ("order_date", "delivery_date")

# State grows with the orders of a delay: it lies on disk, with bounded memory beside it. Keeping the
# number of entries, a metric only, would look every new entry up a second time.
_STORE = "spark.sql.streaming.stateStore"
STATE = {
    f"{_STORE}.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
}


def _is_date(field) -> bool:
    return field.dataType.typeName() == "date"


_MESSAGE = ", ".join(
    f"{f.name} {'string' if _is_date(f) else f.dataType.simpleString()}" for f in ORDERS
)


def encode_orders(df: DataFrame) -> DataFrame:
    """Orders as (key, value) messages: one flat JSON object each, absent values as null."""
    return df.select(F.col(ORDER_KEY).cast("string").alias("key"), order_message().alias("value"))


def order_message() -> Column:
    """The order columns as one flat JSON object."""
    fields = [
        F.date_format(f.name, "yyyy-MM-dd").alias(f.name) if _is_date(f) else F.col(f.name)
        for f in ORDERS
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def decode_feed(messages: DataFrame) -> DataFrame:
    """Order columns of JSON messages in `value` (text or bytes), the message itself as
    `message`, and why it can't be read as `unreadable`, null if it can.

    A message that is not a JSON object is `malformed`; one with text that is no date where a
    date must be is `bad_date`. An unreadable ship date is a missing one, as in batch cleaning.
    """
    text = F.col("value").cast("string")
    decoded = F.from_json(
        text, f"{_MESSAGE}, _bad string", {"columnNameOfCorruptRecord": "_bad"}
    )
    opened = messages.select(text.alias("message"), decoded.alias("order"))
    fields, wrong = [], F.lit(False)
    for f in ORDERS:
        value = F.col("order")[f.name]
        if _is_date(f):
            day = value.try_cast("date")
            if f.name in STRICT_DATES:
                wrong = wrong | (value.isNotNull() & day.isNull())
            value = day
        fields.append(value.alias(f.name))
    broken = F.col("order").isNull() | F.col("order._bad").isNotNull()
    reason = F.when(broken, MALFORMED).when(wrong, BAD_DATE)
    return opened.select(*fields, "message", reason.alias("unreadable"))


def decode_orders(messages: DataFrame) -> DataFrame:
    """Order columns of the readable messages."""
    return readable(decode_feed(messages))


def readable(feed: DataFrame) -> DataFrame:
    return feed.filter(F.col("unreadable").isNull()).drop("message", "unreadable")


def rejects(feed: DataFrame) -> DataFrame:
    """(reason, message) of what could not be read."""
    return feed.filter(F.col("unreadable").isNotNull()).select(
        F.col("unreadable").alias("reason"), "message"
    )


def classify_order_stream(orders: DataFrame, delay: str = "30 days") -> DataFrame:
    """Batch cleaning on a stream: the first copy of an order line to arrive counts, and gets
    the `reject_reason` of the row rules, null if it passes.

    Copies are told by the time they arrive at, so no order is late however old it is. State
    holds one entry per order line for `delay` after its arrival; a copy that is sent again
    later than that counts as new. Unreadable messages of a decoded feed pass as they are,
    each with a key of its own.
    """
    keys = [ORDER_KEY]
    if "unreadable" in orders.columns:
        own = F.when(F.col("unreadable").isNotNull(), F.expr("uuid()"))
        orders, keys = orders.withColumn("_own", own), [ORDER_KEY, "_own"]
    first = (
        orders.withColumn("_arrived", F.current_timestamp())
        .withWatermark("_arrived", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop("_arrived", "_own")
    )
    return normalise_types(first).withColumn("reject_reason", reject_reason())


def clean_order_stream(orders: DataFrame, delay: str = "30 days") -> DataFrame:
    return accepted(classify_order_stream(orders, delay))


def load_order_stream(
    feed: DataFrame,
    clean: str,
    quarantine: str,
    checkpoint: str,
    delay: str = "30 days",
    rejected_to: str | None = None,
) -> StreamingQuery:
    """Clean the stream into one folder, orders without a customer into another, and, for a
    feed of `decode_feed`, unreadable messages with their reason into a third.

    Each batch owns a partition that it replaces, so a batch that runs again after a
    failure does not repeat rows. The batch is written to shared scratch space once, read
    from there by all outputs, and removed when they are done.
    """
    if ("unreadable" in feed.columns) != (rejected_to is not None):
        raise ValueError("a decoded feed needs a place for its rejects, and only such a feed")

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_copy(batch, "orders-batch") as stored:
            orders, outputs = stored, []
            if rejected_to is not None:
                outputs.append((rejects(stored), rejected_to))
                orders = readable(stored)
            outputs.append((accepted(orders), clean))
            outputs.append((rejected(orders, MISSING_CUSTOMER), quarantine))
            for rows, path in outputs:
                rows.write.mode("overwrite").option("compression", "zstd").parquet(
                    f"{path}/batch={batch_id}"
                )

    if rejected_to is not None:  # only what can't be read is wanted as it came
        unread = F.col("unreadable").isNotNull()
        feed = feed.withColumn("message", F.when(unread, F.col("message")))
    return drain_batches(classify_order_stream(feed, delay), write, checkpoint, mode="append")


def running_count(orders: DataFrame) -> DataFrame:
    """Number of messages so far; run in complete mode."""
    return orders.groupBy().agg(F.count("*").alias("messages"))


def _finished(stream: DataFrame, writer: DataStreamWriter) -> StreamingQuery:
    """Process everything the source holds now, and stop. A query keeps the settings it starts with."""
    with usually(stream.sparkSession, STATE):
        query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def drain(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process everything the source holds now, append it to `path`, and stop.

    Offsets and output are committed per batch, so a restart adds nothing twice.
    """
    return _finished(
        stream,
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint),
    )


def drain_batches(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "complete",
) -> StreamingQuery:
    """Like `drain` for results that change: `write` replaces the result after each batch."""
    return _finished(
        stream,
        stream.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint),
    )
