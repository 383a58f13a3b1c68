"""Broadcasts that rest on a measured size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import quoted

# Keys are broadcast up to this many bytes, as counted beforehand.
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 32


def key_bytes(keys: DataFrame) -> int:
    """Bytes the rows would take in a broadcast: their text lengths plus a fixed share per row."""
    lengths = [F.coalesce(F.octet_length(F.col(quoted(c)).cast("string")), F.lit(0)) for c in keys.columns]
    per_row = reduce(lambda a, b: a + b, lengths, F.lit(ROW_OVERHEAD)).cast("bigint")
    return keys.agg(F.sum(per_row).alias("n")).first().n or 0


def broadcast_if_small(keys: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """The keys with a broadcast hint if they were counted to be small, else as they are, so that
    Spark shuffles both sides and splits skewed partitions."""
    return F.broadcast(keys) if key_bytes(keys) <= limit else keys
