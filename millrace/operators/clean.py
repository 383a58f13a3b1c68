"""Repair of fixable data issues before validation.

Spec (every key optional, columns the batch does not have are skipped)::

    {"trim": [...], "lowercase": [...], "fill_null": {column: default},
     "drop_rows_missing": [...], "min_present_fraction": 0.5}

The whole step is one projection and one filter; the counters ride along in the same pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import blank_to_null, strip
from millrace.functions.types import is_floating, is_text, quoted

COUNTERS = ("cells_trimmed", "cells_lowercased", "cells_filled", "rows_dropped")


def _changed(before: Column, after: Column) -> Column:
    return F.when(before.eqNullSafe(after), 0).otherwise(1)


def _total(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, flags, F.lit(0)).cast("bigint")


def _absent(name: str, dtype: T.DataType) -> Column:
    col = F.col(quoted(name))
    return col.isNull() | F.isnan(col) if is_floating(dtype) else col.isNull()


def _fill(name: str, dtype: T.DataType, default) -> Column:
    col = F.col(quoted(name))
    if is_floating(dtype):
        col = F.when(~F.isnan(col), col)
    fits = (
        (isinstance(default, bool) and isinstance(dtype, T.BooleanType))
        or (isinstance(default, str) and is_text(dtype))
        or (isinstance(default, int) and not isinstance(default, bool) and isinstance(dtype, T.NumericType))
        or (isinstance(default, float) and (is_floating(dtype) or isinstance(dtype, T.DecimalType)))
    )
    if fits:
        return F.coalesce(col, F.lit(default).cast(dtype))
    if isinstance(default, float) and isinstance(dtype, T.NumericType):
        return F.coalesce(col.cast("double"), F.lit(default))
    # A default of another kind turns the column into text, as mixed columns are text in Spark.
    return F.coalesce(col.cast("string"), F.lit(str(default)))


def _repair(df: DataFrame, spec: dict, flagged: bool) -> tuple[DataFrame, dict[str, str]]:
    """Trim, lower and fill; with ``flagged`` also one change count per row and counter."""
    flags: dict[str, str] = {}

    def apply(counter, new_columns, changes):
        nonlocal df
        if not new_columns:
            return
        if flagged:
            flag = f"__{counter}"
            flags[counter] = flag
            new_columns = {**new_columns, flag: _total(changes)}
        df = df.withColumns(new_columns)

    types = {f.name: f.dataType for f in df.schema}
    texts = [c for c in spec.get("trim", []) if c in types and is_text(types[c])]
    apply(
        "cells_trimmed",
        {c: blank_to_null(strip(F.col(quoted(c)))) for c in texts},
        [_changed(F.col(quoted(c)), strip(F.col(quoted(c)))) for c in texts],
    )
    texts = [c for c in spec.get("lowercase", []) if c in types and is_text(types[c])]
    apply(
        "cells_lowercased",
        {c: F.lower(F.col(quoted(c))) for c in texts},
        [_changed(F.col(quoted(c)), F.lower(F.col(quoted(c)))) for c in texts],
    )
    fills = {c: v for c, v in (spec.get("fill_null") or {}).items() if c in types}
    apply(
        "cells_filled",
        {c: _fill(c, types[c], v) for c, v in fills.items()},
        [F.when(_absent(c, types[c]), 1).otherwise(0) for c in fills],
    )
    return df, flags


def _kept(df: DataFrame, spec: dict, columns: list[str]) -> Column:
    """Condition under which a repaired row survives the two drop rules."""
    types = {f.name: f.dataType for f in df.schema}
    keep = F.lit(True)
    for name in spec.get("drop_rows_missing", []):
        if name in columns:
            keep = keep & ~_absent(name, types[name])
    fraction = spec.get("min_present_fraction")
    if fraction is not None and columns:
        present = _total([F.when(_absent(c, types[c]), 0).otherwise(1) for c in columns])
        keep = keep & (present >= int(fraction * len(columns)))
    return keep


def clean(df: DataFrame, spec: dict, hidden: tuple[str, ...] = ()) -> DataFrame:
    """The repaired batch. ``hidden`` columns pass through and never count as cells."""
    columns = [c for c in df.columns if c not in hidden]
    repaired, _ = _repair(df, spec, flagged=False)
    return repaired.filter(_kept(repaired, spec, columns))


def _counter_aggregates(flags: dict[str, str], kept: Column) -> list[Column]:
    found = [
        F.coalesce(F.sum(F.col(flags[c])), F.lit(0)).cast("bigint").alias(c)
        if c in flags
        else F.lit(0).cast("bigint").alias(c)
        for c in COUNTERS[:3]
    ]
    return [*found, F.count(F.when(~kept, 1)).alias("rows_dropped")]


def clean_stats(df: DataFrame, spec: dict, hidden: tuple[str, ...] = ()) -> DataFrame:
    """The counters alone, as one row."""
    columns = [c for c in df.columns if c not in hidden]
    repaired, flags = _repair(df, spec, flagged=True)
    return repaired.agg(*_counter_aggregates(flags, _kept(repaired, spec, columns)))


def clean_observed(
    df: DataFrame, spec: dict, observation: Observation, hidden: tuple[str, ...] = ()
) -> DataFrame:
    """Like :func:`clean`, with the counters collected by whichever action consumes the rows."""
    columns = [c for c in df.columns if c not in hidden]
    repaired, flags = _repair(df, spec, flagged=True)
    keep = _kept(repaired, spec, columns)
    aggregates = [F.sum(F.col(flag)).alias(counter) for counter, flag in flags.items()]
    counted = repaired.withColumn("__kept", keep).observe(
        observation,
        F.count(F.lit(1)).alias("rows_delta"),
        F.count(F.when(~F.col("__kept"), 1)).alias("rows_dropped"),
        *aggregates,
    )
    return counted.filter(F.col("__kept")).drop("__kept", *flags.values())
