"""Order message streams: a topic in production, a folder of text files elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TOPIC = "orders"


def topic_options(servers: str, topic: str = TOPIC, **extra: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        **extra,
    }


# What one batch takes at most: messages of a topic, files of a folder.
PER_BATCH = {"kafka": ("maxOffsetsPerTrigger", 5_000_000), "text": ("maxFilesPerTrigger", 1000)}


def read_order_stream(
    spark: SparkSession, source: str = "kafka", per_batch: int | None = None, **options: str
) -> DataFrame:
    """Undecoded messages with a `value` column.

    `source="kafka"` takes the options of `topic_options` and needs Spark's Kafka connector
    on the class path; `source="text"` takes a folder as `path`, one message per line.
    A backlog is consumed in batches of at most `per_batch` messages or files.
    """
    reader = spark.readStream.format(source)
    if source in PER_BATCH:
        name, usual = PER_BATCH[source]
        options.setdefault(name, str(per_batch or usual))
    if source == "text":
        path = options.pop("path")
        return reader.options(**options).load(path)
    return reader.options(**options).load()


def write_messages(
    messages: DataFrame, target: str, fmt: str = "kafka", mode: str = "overwrite", **options: str
) -> None:
    """Publish (key, value) messages to a topic, or to a folder with `fmt="text"`, where
    `mode="append"` adds to what was published before."""
    if fmt == "kafka":
        messages.write.format("kafka").option("topic", target).options(**options).save()
    else:
        messages.select("value").write.mode(mode).format(fmt).options(**options).save(target)
