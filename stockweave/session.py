"""Session settings the package is designed for.

On a cluster the submitter owns the session; nothing below is required for
right results, it is only what a local or test run should start with.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split across tasks at run time from real block sizes.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed streaming state lives on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


GIB = 1 << 30


def sized_for(input_bytes: int) -> dict[str, str]:
    """Shuffle and scan sizes for a given input.

    Adaptive execution merges small shuffle partitions but never adds any except for skewed
    joins, so their number is set for the largest shuffle: about 1 GiB each at most, which
    an executor core sorts with little spilling.
    """
    return {
        "spark.sql.shuffle.partitions": str(max(200, input_bytes // GIB)),
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def get_session(app: str = "stockweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def usually(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings for what is started inside the block; those the session has of its own stay."""
    unset = {k: v for k, v in settings.items() if spark.conf.get(k, None) is None}
    for key, value in unset.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in unset:
            spark.conf.unset(key)
