"""Reading from and writing to an external database over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    single_task: bool = False,
    **extra: str,
) -> dict[str, str]:
    """Options of a JDBC read: `partitions` range queries over `partition_column` at once.

    A read in one task has to be asked for by `single_task`.
    """
    if partition_column is None and not single_task:
        raise ValueError("give a partition column, or ask for a read in a single task")
    options = {"url": url, "dbtable": f"({query}) source_query", "fetchsize": "10000", **extra}
    if partition_column:
        if bounds is None or partitions is None:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, query, **options)).load()


WRITE_CONNECTIONS = 32


def write_options(
    url: str, table: str, connections: int = WRITE_CONNECTIONS, **extra: str
) -> dict[str, str]:
    """Options of a full refresh: rows are replaced, the table and its grants stay.

    `connections` bounds those opened at once, whatever the size of the table.
    """
    return {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": str(connections),
        **extra,
    }
