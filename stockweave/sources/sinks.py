"""Writing layers, extracts, quarantines, warehouse tables and models."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.durable import RELEASE
from stockweave.operators.segments import churn_score_rows
from stockweave.schemas import DIMENSIONS, FACTS, TABLES
from stockweave.session import usually
from stockweave.sources.databases import write_options
from stockweave.sources.tables import CSV


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """A compressed file is read by one task, so it has a million rows at most."""
    writer = df.write.mode("overwrite").options(**CSV)
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", 1_000_000)
    with usually(df.sparkSession, RELEASE):
        writer.csv(path)


def write_layer(
    df: DataFrame,
    base: str,
    layer: str,
    name: str,
    fmt: str = "parquet",
    month_of: str | None = None,
) -> str:
    """Store a table under `<base>/<layer>/<name>`, in parallel from the executors.

    `month_of` names a date column to partition by month. The rebalance hint gathers each
    month into well-sized files and lets adaptive execution split a heavy month.
    """
    path = f"{base.rstrip('/')}/{layer}/{name}"
    writer_input = df
    if month_of:
        writer_input = df.withColumn("month_key", F.date_format(month_of, "yyyy-MM")).hint(
            "rebalance", "month_key"
        )
    writer = writer_input.write.mode("overwrite").format(fmt)
    if fmt == "parquet":
        writer = writer.option("compression", "zstd")
    if fmt == "csv":
        writer = writer.options(**CSV)
    if month_of:
        writer = writer.partitionBy("month_key")
    writer.save(path)
    return path


def publish_zone(df: DataFrame, base: str, zone: str, name: str, fmt: str = "parquet") -> str:
    """Zones are `raw`, `clean` and `ml-outputs`."""
    return write_layer(df, base, zone, name, fmt)


def write_quarantine(df: DataFrame, base: str, reason: str) -> str:
    return write_layer(df, base, "quarantine", reason)


@dataclass
class Warehouse:
    """Where warehouse tables live: files under `location`, catalog tables (`table`), or a
    database or cloud warehouse reached through a data source such as `jdbc`."""

    fmt: str = "parquet"
    location: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def replace(self, df: DataFrame, table: str) -> None:
        with usually(df.sparkSession, RELEASE):
            self._write(df, table)

    def _write(self, df: DataFrame, table: str) -> None:
        writer = df.write.mode("overwrite")
        if self.fmt == "table":
            writer.options(**self.options).saveAsTable(table)
        elif self.fmt == "jdbc":
            writer.format("jdbc").options(**write_options(table=table, **self.options)).save()
        elif self.location:
            writer.format(self.fmt).options(**self.options).save(f"{self.location}/{table}")
        else:
            writer.format(self.fmt).options(**self.options, dbtable=table).save()

    def clear(self, df: DataFrame, table: str) -> None:
        self.replace(df.limit(0), table)


@dataclass
class PublishedWarehouse(Warehouse):
    """Tables that readers know by view names, `database`.name, over files under `location`.

    Every load writes files of its own; the views are pointed to them when all tables of a load
    are written. A load that fails changes nothing that readers see, and its files are
    never pointed to. Files of earlier loads stay for readers that began with them.
    """

    database: str = "default"
    pending: dict[str, str] = field(default_factory=dict)

    def replace(self, df: DataFrame, table: str) -> None:
        path = f"{self.location}/{table}/load-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").format(self.fmt).options(**self.options).save(path)
        self.pending[table] = path

    def clear(self, df: DataFrame, table: str) -> None:
        """Nothing to empty: the tables readers see are replaced as a whole."""

    def publish(self, spark: SparkSession) -> None:
        """Point the views to what was written since the last time."""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}`")
        for table, path in self.pending.items():
            spark.sql(
                f"CREATE OR REPLACE VIEW `{self.database}`.`{table}`"
                f" AS SELECT * FROM {self.fmt}.`{path}`"
            )
        self.pending.clear()

    def discard(self) -> None:
        """Forget what a failed load wrote."""
        self.pending.clear()


def full_refresh(df: DataFrame, table: str, warehouse: Warehouse) -> None:
    """Replace all rows of a table; nulls are kept."""
    declared = TABLES.get(table)
    typed = df if declared is None else df.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared]
    )
    warehouse.replace(typed, table)


def refresh_star_schema(tables: Mapping[str, DataFrame], warehouse: Warehouse) -> None:
    """Full refresh of a whole star: facts are emptied before their dimensions, and
    dimensions are loaded before the facts that refer to them."""
    for name in (*FACTS, *DIMENSIONS):
        if name in tables:
            warehouse.clear(tables[name], name)
    for name in (*DIMENSIONS, *FACTS):
        if name in tables:
            full_refresh(tables[name], name, warehouse)


@contextmanager
def published(warehouse: Warehouse, spark: SparkSession) -> Iterator[Warehouse]:
    """A load whose tables become visible together at its end, or not at all if it fails,
    where the warehouse can do that."""
    try:
        yield warehouse
    except BaseException:
        if isinstance(warehouse, PublishedWarehouse):
            warehouse.discard()
        raise
    if isinstance(warehouse, PublishedWarehouse):
        warehouse.publish(spark)


def write_scores(
    scored: DataFrame, probability, warehouse: Warehouse, as_of: dt.date | None = None
) -> None:
    full_refresh(churn_score_rows(scored, probability, as_of), "ml_churn_scores", warehouse)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)
