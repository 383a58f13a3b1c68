"""Mergeable sketches: quantiles and distinct counts of columns for any range of runs.

A sketch of a column is a few kilobytes however many rows it has seen, and sketches of several runs merge into
the sketch of all their rows. So quantiles and distinct counts over any range of runs or days come from a few
stored rows, without the data and without a shuffle of values.

Quantiles are KLL sketches of ``KLL_K`` entries: the true rank of a returned value is within ``RANK_ERROR`` of
the one asked for. Distinct counts are Theta sketches of ``2**THETA_LG`` entries: exact up to that many values,
beyond it with a standard error of ``DISTINCT_ERROR`` of the count; they can also tell how many values of one
set are not in another. Values are known to them by a 64-bit hash. NULL and NaN are no values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.types import is_floating, is_measurable, quoted
from millrace.operators.duplicates import cell_text

KLL_K = 400
# Twice what holds in 99 of 100 cases (2.296 / k ** 0.9723).
RANK_ERROR = 2 * 2.296 / KLL_K**0.9723
THETA_LG = 12
DISTINCT_ERROR = 2 ** (-THETA_LG / 2)

SCHEMA = "column string, n bigint, quantiles binary, distinct binary"


def value_hash(name: str, dtype: T.DataType) -> Column:
    """A value's 64-bit hash, equal where values are equal; NULL for NULL and NaN."""
    text = cell_text(name, dtype)
    return F.when(text.isNotNull(), F.xxhash64(text))


def distinct_sketch(name: str, dtype: T.DataType, lg: int = THETA_LG) -> Column:
    return F.theta_sketch_agg(value_hash(name, dtype), F.lit(lg))


def _number(name: str, dtype: T.DataType) -> Column:
    col = F.col(quoted(name))
    return F.when(~F.isnan(col), col).cast("double") if is_floating(dtype) else col.cast("double")


def sketch_aggregates(df: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates of one pass: per column the values, their quantiles (of numbers) and the distinct ones."""
    found = []
    for c in columns:
        dtype = df.schema[c].dataType
        found.append(F.count(value_hash(c, dtype)).alias(f"n:{c}"))
        if is_measurable(dtype):
            found.append(F.kll_sketch_agg_double(_number(c, dtype), F.lit(KLL_K)).alias(f"quantiles:{c}"))
        found.append(distinct_sketch(c, dtype).alias(f"distinct:{c}"))
    return found


def sketch_columns(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """(by.., column, n, quantiles, distinct): one row per group and column, from a single scan."""
    by = by or []
    wide = df.groupBy(*[F.col(quoted(b)) for b in by]).agg(*sketch_aggregates(df, columns))
    none = F.lit(None).cast("binary")
    rows = [
        F.struct(
            F.lit(c).alias("column"), F.col(quoted(f"n:{c}")).alias("n"),
            (F.col(quoted(f"quantiles:{c}")) if f"quantiles:{c}" in wide.columns else none).alias("quantiles"),
            F.col(quoted(f"distinct:{c}")).alias("distinct"),
        )
        for c in columns
    ]
    return wide.select(*[F.col(quoted(b)) for b in by], F.inline(F.array(*rows)))


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of several runs or days as one per ``by`` (such as dataset and column)."""
    return sketches.groupBy(*[F.col(quoted(b)) for b in by]).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
        F.theta_union_agg("distinct", F.lit(THETA_LG)).alias("distinct"),
    )


def quantiles(sketches: DataFrame, by: list[str], ranks: list[float]) -> DataFrame:
    """The values at some ranks (0.5 is the median) over all given sketches; NULL without numbers."""
    whole = merged(sketches, by)
    known = F.col("quantiles").isNotNull() & (F.kll_sketch_get_n_double("quantiles") > 0)
    found = {
        f"p{rank * 100:g}": F.when(known, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(rank)))) for rank in ranks
    }
    return whole.select(*[F.col(quoted(b)) for b in by], "n", *[c.alias(n) for n, c in found.items()])


def distinct_counts(sketches: DataFrame, by: list[str]) -> DataFrame:
    """How many different values all given sketches saw."""
    return merged(sketches, by).select(
        *[F.col(quoted(b)) for b in by], F.theta_sketch_estimate("distinct").alias("distinct_values")
    )


def new_values(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """Per ``by``: how many values ``after`` has, and how many of them ``before`` does not."""
    was = merged(before, by).select(*by, F.col("distinct").alias("was"))
    now = merged(after, by).select(*by, F.col("distinct").alias("now"))
    fresh = F.when(F.col("was").isNull(), F.col("now")).otherwise(F.theta_difference("now", "was"))
    return now.join(was, by, "left").select(
        *by, F.theta_sketch_estimate("now").alias("distinct_values"), F.theta_sketch_estimate(fresh).alias("new_values")
    )
