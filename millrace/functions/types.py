"""Data type names and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import TransformError

# Dtype names accepted in a cast spec -> Spark type.
CAST_TYPES = {
    "str": "string",
    "string": "string",
    "object": "string",
    "int": "bigint",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "Int64": "bigint",
    "float": "double",
    "float32": "float",
    "float64": "double",
    "bool": "boolean",
    "boolean": "boolean",
    "datetime64[ns]": "timestamp",
}


def spark_type(name: str) -> str:
    if name not in CAST_TYPES:
        raise TransformError(f"unknown cast type {name!r}; known: {', '.join(CAST_TYPES)}")
    return CAST_TYPES[name]


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_measurable(dtype: T.DataType) -> bool:
    """Numeric in the wide sense used for statistics: booleans count as 0 and 1."""
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def measurable_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema if is_measurable(f.dataType) and f.name not in set(exclude)]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers have one spelling, NULL, from the scan onwards."""
    floats = [f.name for f in df.schema if is_floating(f.dataType)]
    return df.withColumns({c: F.when(~F.isnan(quoted(c)), F.col(quoted(c))) for c in floats}) if floats else df


def quoted(name: str) -> str:
    """A column name safe to hand to F.col, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
