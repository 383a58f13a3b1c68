"""Lenient number parsing and score arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGER_PATTERN = r"^[+-]?[0-9]+$"
# Spark's own cast also takes Java suffixes such as "1d"; the pattern keeps those out.
DECIMAL_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITY_PATTERN = r"(?i)^[+-]?inf(inity)?$"


def parse_number(col: Column, dtype: T.DataType) -> Column:
    """The value as double, or NULL where it does not read as a number."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.nanvl(col.cast("double"), F.lit(None).cast("double"))
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return col.cast("double")
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        bare = F.trim(col)
        return F.when(
            bare.rlike(DECIMAL_PATTERN) | bare.rlike(INFINITY_PATTERN), bare.try_cast("double")
        )
    return F.lit(None).cast("double")


def score(violations: Column, checked: Column) -> Column:
    """100 for no violation, 0 when every checked value is one; never negative."""
    share = F.lit(1.0) - violations.cast("double") / F.when(checked > 0, checked.cast("double"))
    return F.when(checked > 0, F.greatest(F.lit(0.0), F.lit(100.0) * share)).otherwise(100.0)
