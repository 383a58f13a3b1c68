"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.joins import BROADCAST_BYTES
from millrace.session import scratch_path


# A partition of a table whose size is known has about so many rows.
PARTITION_ROWS = 200_000
LEAST_PARTITIONS = 6


def staged(df: DataFrame, purpose: str, most_rows: int | None = None) -> DataFrame:
    """Write the rows as Parquet under the shared folder and read them back.

    Cuts the lineage where rows are used more than once, so a lost executor costs a read and not the
    work before it. The files go when the session ends. Where the caller knows how many rows there are
    at most, they are written by as many tasks as that takes, so that small tables make few small files. That is for
    plans that do not sort: a task keeps the memory of all its partitions' sorters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    if most_rows is not None:
        df = df.coalesce(max(LEAST_PARTITIONS, -(-most_rows // PARTITION_ROWS)))
    df.write.parquet(path)
    forget_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of whole sets or texts that go to a Python worker at once.
WIDE_ROWS = 256
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def small_batches(spark: SparkSession):
    """What is run in here hands wide rows to Python workers few at a time."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(WIDE_ROWS))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


# Bytes of whole texts that go to a Python worker at once.
TEXT_BYTES = 4 * 1024 * 1024
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def text_batches(spark: SparkSession):
    """What is run in here hands texts to Python workers by their bytes, however long they are."""
    before = spark.conf.get(_BYTES)
    spark.conf.set(_BYTES, str(TEXT_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BYTES, before)


def broadcast_if_few(rows: DataFrame, row_bytes: int) -> DataFrame:
    """A staged table with a broadcast hint if its counted rows, of at most ``row_bytes`` each, are small; else
    as it is, so that Spark shuffles both sides of a join and splits skewed keys."""
    return F.broadcast(rows) if rows.count() * row_bytes <= BROADCAST_BYTES else rows


def forget_at_exit(spark: SparkSession, path: str) -> None:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(location)


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not use yet, whatever its letters' case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted

