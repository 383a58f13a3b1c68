"""Counts of repeated values and repeated rows.

All counts come from ``groupBy(...).count()``: map tasks pre-aggregate, so a value that fills a
third of the table travels as one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.types import is_floating, is_text, quoted

# Longer strings are compared by length and SHA-256 digest, so that whole texts need not travel.
INLINE_BYTES = 32
# JSON text of nested values is equal exactly where the values are.
TO_THE_MICROSECOND = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}
# Rows of at most this many fixed-size columns are compared as they are.
INLINE_COLUMNS = 4


def _group_key(name: str, dtype: T.DataType) -> list[Column]:
    col = F.col(quoted(name))
    if isinstance(dtype, (T.MapType, T.VariantType)):
        col, dtype = F.to_json(col, TO_THE_MICROSECOND), T.StringType()
    if is_floating(dtype):
        return [F.when(~F.isnan(col), col).alias(f"k_{name}")]
    if is_text(dtype) or isinstance(dtype, T.BinaryType):
        raw = col.cast("binary")
        short = F.octet_length(col) <= INLINE_BYTES
        return [
            F.octet_length(col).alias(f"n_{name}"),
            F.when(short, raw).otherwise(F.unhex(F.sha2(raw, 256))).alias(f"k_{name}"),
        ]
    return [col.alias(f"k_{name}")]


def _surplus(groups: DataFrame) -> DataFrame:
    return groups.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("n"))


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """One row ``n``: how many values of the column repeat an earlier one (NULLs are equal)."""
    packed = df.select(*_group_key(column, df.schema[column].dataType))
    return _surplus(packed.groupBy(*[F.col(quoted(k)) for k in packed.columns]).count())


def cell_text(name: str, dtype: T.DataType) -> Column:
    """A cell as text that is equal exactly where the values are equal."""
    col = F.col(quoted(name))
    if is_floating(dtype):
        return F.when(~F.isnan(col), col + F.lit(0.0).cast(dtype)).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType, T.VariantType)):
        return F.to_json(col, TO_THE_MICROSECOND)
    return col.cast("string")


def row_digest(fields: list[T.StructField]) -> Column:
    """SHA-256 of all cells, each led by its length, so no two different rows read the same."""
    cells = []
    for f in fields:
        text = cell_text(f.name, f.dataType)
        cells.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*cells), 256))


def repeated_rows(df: DataFrame, hidden: tuple[str, ...] = ()) -> DataFrame:
    """One row ``n``: how many rows repeat an earlier row in every column.

    A few fixed-size columns travel as they are, anything wider as one digest per row.
    """
    fields = [f for f in df.schema if f.name not in hidden]
    small = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if len(fields) <= INLINE_COLUMNS and all(isinstance(f.dataType, small) for f in fields):
        keys = [k for f in fields for k in _group_key(f.name, f.dataType)]
    else:
        keys = [row_digest(fields).alias("row")]
    packed = df.select(*keys)
    return _surplus(packed.groupBy(*[F.col(quoted(k)) for k in packed.columns]).count())
