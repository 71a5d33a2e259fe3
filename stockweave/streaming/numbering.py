"""Message numbers without gaps, and consumption of the first n messages at a time.

Structured Streaming hands over batches; both operators number what a batch holds by prefix
sums: the rows are sorted, every partition counts its own, and the counts of the partitions
before it are added. No task sees all rows. What earlier batches held is kept as one row
per batch next to the output, so a batch that runs again gets the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from stockweave.durable import scratch_copy
from stockweave.sources.tables import if_exists

NUMBER = "message_number"
_ROW_BITS = 33  # monotonically_increasing_id has the row of a partition in these

POLL_SECONDS = 0.2


def number_rows(stored: DataFrame, start: int) -> tuple[DataFrame, int]:
    """(rows with their number, how many there are), from rows stored with `_row`, an id that
    grows along their order within partitions that follow each other."""
    part = F.shiftright("_row", _ROW_BITS)
    counts = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows")).collect()
    before, total = [], 0
    for r in sorted(counts, key=lambda r: r["_part"]):  # one row per partition of the sort
        before.append((r["_part"], total))
        total += r["_rows"]
    if not before:
        return stored.withColumn(NUMBER, F.lit(None).cast("long")).drop("_row"), 0
    offsets = stored.sparkSession.createDataFrame(before, "_part long, _before long")
    row = F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    numbered = stored.withColumn("_part", part).join(offsets, "_part")
    return (
        numbered.withColumn(NUMBER, F.col("_before") + row + F.lit(start + 1)).drop(
            "_row", "_part", "_before"
        ),
        total,
    )


def _sorted(batch: DataFrame, order: Sequence[str]) -> DataFrame:
    rest = [c for c in batch.columns if c not in order]
    return batch.orderBy(*order, *rest).withColumn("_row", F.monotonically_increasing_id())


def _counted(spark: SparkSession, path: str, before: int) -> int:
    """Rows of the batches before batch number `before`."""
    counts = if_exists(
        lambda: spark.read.schema("batch long, row_count long").parquet(f"{path}/counts")
    )
    if counts is None:
        return 0
    found = counts.filter(F.col("batch") < before).agg(F.sum("row_count")).first()[0]
    return found or 0


def _store_batch(batch: DataFrame, batch_id: int, path: str, order: Sequence[str]) -> None:
    """Number a batch and write it, and its count, to places of its own."""
    spark = batch.sparkSession
    start = _counted(spark, path, batch_id)
    with scratch_copy(_sorted(batch, order), "numbered") as stored:
        numbered, total = number_rows(stored, start)
        numbered.write.mode("overwrite").option("compression", "zstd").parquet(
            f"{path}/messages/batch={batch_id}"
        )
    count = spark.range(1).select(F.lit(total).cast("long").alias("row_count"))
    count.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")


def number_stream(
    stream: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ()
) -> StreamingQuery:
    """Number all messages the source holds now, in `path`/messages.

    Messages of a batch are numbered in the order of the columns `order`, then of the others;
    batches follow each other. Numbers begin with 1 and have no gaps, over restarts too.
    """
    query = _start(stream, path, checkpoint, order)
    query.awaitTermination()
    return query


def _start(stream: DataFrame, path: str, checkpoint: str, order: Sequence[str]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(
            lambda batch, batch_id: _store_batch(batch, batch_id, path, order)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def numbered_messages(spark: SparkSession, path: str) -> DataFrame | None:
    """What has been numbered so far: the messages of `number_stream` or `consume_first`."""
    found = if_exists(lambda: spark.read.parquet(f"{path}/messages"))
    return None if found is None else found.drop("batch")


def consume_first(
    stream: DataFrame, n: int, path: str, checkpoint: str, order: Sequence[str] = ()
) -> DataFrame:
    """The next `n` messages, numbered, or as many as there are; the rest waits.

    Batches are taken from the source only until enough messages are numbered. How far the
    runs before came is kept in `path`/runs; the run's messages are stored in
    `path`/taken/run=K before that, so a run that failed is repeated as it was. Runs join
    without gap or repeat.
    """
    spark = stream.sparkSession
    runs = if_exists(
        lambda: spark.read.schema("run long, last_number long").parquet(f"{path}/runs")
    )
    found = runs.agg(F.count("*"), F.max("last_number")).first() if runs is not None else (0, None)
    run, last = found[0], found[1] or 0

    def numbered() -> int:
        return _counted(spark, path, 1 << 62)

    if numbered() < last + n:
        query = _start(stream, path, checkpoint, order)
        while not query.awaitTermination(POLL_SECONDS):
            if numbered() >= last + n:
                query.stop()  # a batch that is cut off runs again, with the same numbers
                break
    # a batch that was cut off has messages but no count yet
    total = min(numbered(), last + n)
    messages = numbered_messages(spark, path)
    if messages is None:  # the source has never held any
        return stream.sparkSession.createDataFrame(
            [], StructType([*stream.schema, StructField(NUMBER, LongType())])
        )
    taken = messages.filter(F.col(NUMBER).between(last + 1, total))
    taken.write.mode("overwrite").parquet(f"{path}/taken/run={run}")
    mark = spark.range(1).select(F.lit(total).cast("long").alias("last_number"))
    mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/run={run}")
    return spark.read.schema(taken.schema).parquet(f"{path}/taken/run={run}")
