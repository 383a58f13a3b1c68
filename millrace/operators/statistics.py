"""Column moments, running baselines and z-score anomalies.

A baseline is (count, mean, m2) per dataset and column, so it grows with the number of columns and
never with the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import is_floating, measurable_columns, quoted
from millrace.operators.sequence import HOT_KEY_ROWS, along_key, pieces_needed

# A baseline is judged from this many samples on, and beyond this z-score.
MIN_BASELINE_SAMPLES = 3
Z_THRESHOLD = 3.0

STATS_SCHEMA = "dataset string, column string, count bigint, mean double, m2 double"


def _value(df: DataFrame, name: str) -> Column:
    col = F.col(quoted(name))
    if is_floating(df.schema[name].dataType):
        col = F.when(~F.isnan(col), col)
    return col.cast("double")


def moment_aggregates(df: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates for one pass over the batch, shared with whatever else that pass computes."""
    return [
        aggregate(_value(df, c)).alias(f"{label}:{c}")
        for c in columns
        for label, aggregate in (("count", F.count), ("mean", F.avg), ("variance", F.var_pop))
    ]


def column_moments(df: DataFrame, exclude=()) -> DataFrame:
    """(column, count, mean, variance) for every measurable column, from a single scan."""
    columns = measurable_columns(df, exclude)
    row = df.agg(*moment_aggregates(df, columns))
    each = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(quoted(f"count:{c}")).alias("count"),
            F.col(quoted(f"mean:{c}")).alias("mean"),
            F.col(quoted(f"variance:{c}")).alias("variance"),
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*each))).filter(F.col("count") > 0)


def _joined(moments: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    was = baseline.select(
        *keys, F.col("count").alias("b_count"), F.col("mean").alias("b_mean"), F.col("m2").alias("b_m2")
    )
    return moments.join(was, keys, "full_outer").fillna(0, ["count", "b_count"]).fillna(0.0, ["b_m2"])


def merge_baseline(moments: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """The baseline after taking in a batch; columns on one side only pass through."""
    n, b = F.col("count"), F.col("b_count")
    total = n + b
    shift = F.coalesce(F.col("mean"), F.col("b_mean")) - F.coalesce(F.col("b_mean"), F.col("mean"))
    both = shift * n / total
    return _joined(moments, baseline, keys).select(
        *keys,
        total.cast("bigint").alias("count"),
        (F.coalesce(F.col("b_mean"), F.col("mean")) + both).alias("mean"),
        (F.col("b_m2") + F.coalesce(F.col("variance"), F.lit(0.0)) * n + shift * shift * b * n / total).alias("m2"),
    )


def _flagged(frame: DataFrame, value, count, mean, m2) -> DataFrame:
    stddev = F.sqrt(m2 / F.when(count > 0, count))
    judged = (count >= MIN_BASELINE_SAMPLES) & (stddev > 0)
    z = (value - mean) / F.when(stddev > 0, stddev)
    return frame.withColumns(
        {
            "value": value, "baseline_mean": mean, "baseline_stddev": stddev,
            "z_score": F.when(judged, z),
            "is_anomaly": F.coalesce(judged & (F.abs(z) > Z_THRESHOLD), F.lit(False)),
        }
    )


def z_scores(moments: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """Each batch mean against the baseline as it was before the batch."""
    was = baseline.select(
        *keys, F.col("count").alias("b_count"), F.col("mean").alias("b_mean"), F.col("m2").alias("b_m2")
    )
    joined = moments.join(was, keys, "left")
    flagged = _flagged(
        joined, F.col("mean"), F.coalesce(F.col("b_count"), F.lit(0)), F.col("b_mean"), F.col("b_m2")
    )
    return flagged.select(*keys, "value", "baseline_mean", "baseline_stddev", "z_score", "is_anomaly")


def judge_and_merge(moments: DataFrame, baseline: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the verdict on the batch and the baseline that includes it."""
    verdict = z_scores(moments, baseline, keys)
    return merge_baseline(moments, baseline, keys).join(verdict, keys, "left")


def backtest(
    history: DataFrame, keys: list[str], order_by: list[str], *, hot_key_rows: int | None = HOT_KEY_ROWS
) -> DataFrame:
    """Judge every run of a whole history against all runs before it, in one job.

    ``history`` has count, mean and variance per key and run. The sequential merge collapses to
    running sums; means are taken relative to the key's first run, which keeps the sums small.
    """
    pieces = pieces_needed(history, keys, hot_key_rows)
    runs = along_key(
        history, keys, order_by, pieces=pieces, first={"__pivot": F.struct(F.col("mean").alias("m"))}
    ).withColumn("__pivot", F.col("__pivot")["m"])
    off = F.col("mean") - F.col("__pivot")
    n = F.col("count")
    runs = along_key(
        runs, keys, order_by, pieces=pieces,
        sums_before={
            "__n": n, "__s": n * off, "__q": n * F.col("variance") + n * off * off,
        },
    )
    total = F.coalesce(F.col("__n"), F.lit(0))
    mean = F.col("__pivot") + F.col("__s") / F.when(total > 0, total)
    m2 = F.greatest(F.col("__q") - F.col("__s") * F.col("__s") / F.when(total > 0, total), F.lit(0.0))
    return _flagged(runs.withColumn("baseline_count", total.cast("bigint")), F.col("mean"), total, mean, m2).drop(
        "__pivot", "__n", "__s", "__q"
    )
