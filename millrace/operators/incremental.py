"""Incremental reads: keep only rows past a watermark.

The watermark column decides how values compare: timestamps and dates as times, numbers as
numbers, strings as times where both sides read as times and otherwise as text. The bound is
always a literal on the far side of the comparison, so it reaches the Parquet or JDBC scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.times import parse_time
from millrace.functions.types import is_floating, quoted


def watermark_time(spark, watermark: str) -> datetime | None:
    """The watermark as session-zone wall-clock time, or None if it is no time."""
    row = spark.range(1).select(
        F.lit(str(watermark)).try_cast("timestamp").cast("timestamp_ntz").alias("t")
    ).first()
    return row.t


def watermark_kind(df: DataFrame, column: str, watermark: str | None) -> str:
    """``time``, ``number`` or ``text`` for this column and watermark."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    if isinstance(dtype, T.NumericType):
        return "number"
    if watermark is None or watermark_time(df.sparkSession, watermark) is None:
        return "text"
    # Stops at the first value that reads as a time; only an all-text column is read to its end.
    some_time = df.filter(parse_time(F.col(quoted(column)), dtype).isNotNull()).limit(1)
    return "text" if some_time.isEmpty() else "time"


def newer_than(
    df: DataFrame, column: str, watermark: str, grace_seconds: float = 0, kind: str | None = None
) -> Column:
    """Predicate for rows after the watermark, less the grace period for late rows."""
    dtype = df.schema[column].dataType
    col = F.col(quoted(column))
    kind = kind or watermark_kind(df, column, watermark)
    if kind == "time":
        bound = watermark_time(df.sparkSession, watermark)
        if bound is None:
            raise ValueError(f"watermark {watermark!r} does not read as a time")
        bound -= timedelta(seconds=grace_seconds)
        limit = F.lit(bound.isoformat(sep=" "))
        if isinstance(dtype, T.TimestampNTZType):
            return col > limit.cast("timestamp_ntz")
        if isinstance(dtype, T.DateType):
            # A day is past the bound exactly when its midnight is; compare days so it pushes down.
            return col > F.lit(bound.date().isoformat()).cast("date")
        if isinstance(dtype, T.TimestampType):
            return col > limit.cast("timestamp")
        return parse_time(col, dtype) > limit.cast("timestamp")
    if kind == "number":
        try:
            number = Decimal(str(watermark))
        except InvalidOperation as exc:
            raise ValueError(f"watermark {watermark!r} does not read as a number") from exc
        if is_floating(dtype):
            return col > F.lit(float(number))
        if number == number.to_integral_value() and abs(number) < 2**63:
            return col > F.lit(int(number))
        return col > F.lit(number)
    return col.cast("string") > F.lit(str(watermark))


def filter_incremental(
    df: DataFrame, column: str, watermark: str | None, grace_seconds: float = 0,
    kind: str | None = None,
) -> DataFrame:
    """Rows newer than ``watermark``; all rows when there is no watermark or no such column."""
    if not watermark or column not in df.columns:
        return df
    return df.filter(newer_than(df, column, watermark, grace_seconds, kind))


def watermark_max(df: DataFrame, column: str) -> Column:
    """Aggregate for the newest value of a batch as text; NULL for an empty batch.

    A string column compares as text here, as it has no type to order by; ISO times order right.
    """
    col = F.col(quoted(column))
    if is_floating(df.schema[column].dataType):
        col = F.when(~F.isnan(col), col)
    return F.max(col).cast("string")


def compute_watermark(df: DataFrame, column: str) -> str | None:
    if column not in df.columns:
        return None
    return df.agg(watermark_max(df, column).alias("w")).first().w


def advance_watermark(
    spark, old: str | None, new: str | None, dtype: T.DataType, kind: str
) -> str | None:
    """The later of two watermarks: a batch holding only late rows never moves it back."""
    if not old or new is None:
        return new if new is not None else old
    if kind == "number":
        return new if Decimal(new) > Decimal(old) else old
    if kind == "time":
        was, now = watermark_time(spark, old), watermark_time(spark, new)
        return new if was is None or (now is not None and now > was) else old
    return max(old, new)
