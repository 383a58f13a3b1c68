"""Reshape step: rename, cast, dedupe, select, always in that order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.errors import TransformError
from millrace.functions.types import quoted, spark_type


def _require(df: DataFrame, columns, purpose: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise TransformError(f"cannot {purpose}: no column {', '.join(map(repr, missing))}")


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def cast(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """ANSI casts: a value that does not fit fails the job instead of turning into NULL."""
    _require(df, types, "cast")
    return df.withColumns({c: F.col(quoted(c)).cast(spark_type(t)) for c, t in types.items()})


def one_per_key(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """The first row of every key in the given order.

    ``row_number() = 1`` lets Spark cut each key to one row per map task before the shuffle, so a
    key holding a third of the table arrives as a handful of rows.
    """
    rank = F.row_number().over(Window.partitionBy(*[F.col(quoted(k)) for k in keys]).orderBy(*order_by))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def last_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last row of every key."""
    return one_per_key(df, keys, [F.col(quoted(c)).desc() for c in order_by])


def dedupe_keep_first(df: DataFrame, keys: list[str], order_by: list | None = None) -> DataFrame:
    """One row per key; any of them when no order is given."""
    _require(df, keys, "drop duplicates")
    return one_per_key(df, keys, order_by) if order_by else df.dropDuplicates(keys)


def select(df: DataFrame, columns: list[str], hidden: tuple[str, ...] = ()) -> DataFrame:
    _require(df, columns, "select")
    return df.select(*[F.col(quoted(c)) for c in [*columns, *hidden]])


def transform(
    df: DataFrame, spec: dict, order_by: list | None = None, hidden: tuple[str, ...] = ()
) -> DataFrame:
    """Apply ``{"rename", "cast", "drop_duplicates", "select"}``.

    ``order_by`` names the columns (as they are called after the rename) that decide which
    duplicate comes first. ``hidden`` columns survive the select.
    """
    if spec.get("rename"):
        df = rename(df, spec["rename"])
    if spec.get("cast"):
        df = cast(df, spec["cast"])
    if spec.get("drop_duplicates"):
        df = dedupe_keep_first(df, spec["drop_duplicates"], order_by)
    if spec.get("select"):
        df = select(df, spec["select"], hidden)
    return df
