"""Intermediate results that outlive the executors that produced them.

Anything read by more than one job (order-statistic rounds, two sinks fed by one
cleaning pass) is written once to the cluster's shared scratch folder and read
back as Parquet, so later jobs scan only the columns they need and a lost
executor costs a re-read, not a re-computation. The folder is `spark.checkpoint.dir`,
or one beside the warehouse where that is unset. It is scratch space: what a finished
run left there may be removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from stockweave.session import usually

# What a job shuffled goes when the job ends, and not when the driver happens to collect its garbage.
RELEASE = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def scratch_dir(spark: SparkSession) -> str:
    """Shared scratch folder: `spark.checkpoint.dir`, else `_scratch` in the shared warehouse."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current is None:
        current = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the scratch folder once and return a scan of what was written."""
    return _stored(df, scratch_path(df.sparkSession, label))


@contextmanager
def scratch_copy(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """As `durable`, for use inside the block only: the copy is removed at its end."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield _stored(df, path)
    finally:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the scratch space, in whatever store it is."""
    if not path.startswith(scratch_dir(spark).rstrip("/") + "/"):
        raise ValueError("not in the scratch folder")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _stored(df: DataFrame, path: str) -> DataFrame:
    with usually(df.sparkSession, RELEASE):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
