"""Reading the star-schema tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from stockweave.schemas import DIMENSIONS, FACTS, TABLES

# Texts that mean "no value" in an input file.
NULL_MARKERS = ("", "NA", "N/A", "n/a", "NULL", "null", "NaN", "nan", "None", "<NA>", "#N/A")

# Columns where unreadable text is a missing value rather than an error.
LENIENT = {"ship_date"}


def _conform(field: StructField) -> Column:
    name, kind = field.name, field.dataType
    value = F.when(~F.trim(F.col(name)).isin(*NULL_MARKERS), F.col(name))
    if isinstance(kind, StringType):
        return value.alias(name)
    if field.name in LENIENT:
        return value.try_cast(kind).alias(name)
    if isinstance(kind, (IntegerType, LongType)):
        # a writer that keeps nullable integers as floats leaves texts like `12.0`
        return value.cast("decimal(38,6)").cast(kind).alias(name)
    return value.cast(kind).alias(name)


# Quotes inside a quoted field are doubled; this is how other tools write and read CSV.
CSV = {"header": "true", "quote": '"', "escape": '"'}


def read_raw(
    spark: SparkSession, name: str, path: str, multi_line: bool = False
) -> DataFrame:
    """A CSV table exactly as stored: every column is text.

    A row with another number of fields than the header is an error. `multi_line` allows line
    breaks inside quoted fields; a file is then read by one task, as it can't be split.
    """
    text = StructType([StructField(f.name, StringType(), True) for f in TABLES[name]])
    return (
        spark.read.schema(text)
        .options(**CSV)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("enforceSchema", False)  # a header that disagrees with the schema is an error
        .csv(path)
    )


def conform(text: DataFrame, name: str) -> DataFrame:
    """Raw text columns as the declared types, with null markers resolved."""
    return text.select(*[_conform(f) for f in TABLES[name]])


def read_table(
    spark: SparkSession, name: str, path: str, fmt: str = "csv", multi_line: bool = False
) -> DataFrame:
    """A table with its declared types, from CSV or any columnar format Spark knows."""
    if fmt == "csv":
        return conform(read_raw(spark, name, path, multi_line), name)
    stored = spark.read.format(fmt).load(path)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[name]])


def if_exists(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What `read` opens, or None where nothing is stored at its path."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_if_exists(
    spark: SparkSession, name: str, path: str, fmt: str = "csv"
) -> DataFrame | None:
    return if_exists(lambda: read_table(spark, name, path, fmt))


def read_tables(
    spark: SparkSession, base: str, fmt: str = "csv", names: Sequence[str] = (*DIMENSIONS, *FACTS)
) -> dict[str, DataFrame]:
    """Tables stored under `base`, one file (`<name>.csv`) or folder (`<name>`) each."""
    suffix = ".csv" if fmt == "csv" else ""
    found = {}
    for name in names:
        table = read_if_exists(spark, name, f"{base}/{name}{suffix}", fmt)
        found[name] = read_table(spark, name, f"{base}/{name}", fmt) if table is None else table
    return found


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables and models known by name, so that SQL can refer to them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
