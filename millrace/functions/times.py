"""Lenient time parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000


def parse_time(col: Column, dtype: T.DataType) -> Column:
    """The value as timestamp, or NULL where it does not read as a time.

    Numbers are not times here: a numeric watermark column is compared as a number.
    """
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return col.cast("timestamp")
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return F.trim(col).try_cast("timestamp")
    return F.lit(None).cast("timestamp")


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, floored (so -1 for a time in the near future)."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("bigint")
