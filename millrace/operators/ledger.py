"""Analytics over the run ledger.

The ledger is an append-only table of status events; a run's present state is its latest event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.operators.sequence import HOT_KEY_ROWS, along_key, pieces_needed
from millrace.operators.transform import last_per_key

# Run states.
PENDING, RUNNING, RETRYING, SUCCEEDED, FAILED = (
    "PENDING", "RUNNING", "RETRYING", "SUCCEEDED", "FAILED",
)
STATUSES = (PENDING, RUNNING, RETRYING, SUCCEEDED, FAILED)
IN_FLIGHT = (PENDING, RUNNING, RETRYING)

# Upper bounds of the duration histogram in seconds; one more bucket is open-ended.
DURATION_BOUNDS = (
    0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0,
)


def run_current_state(events: DataFrame, run: str = "run_id", order_by: tuple[str, ...] = ("event_ts", "seq")) -> DataFrame:
    """The latest event of every run; map tasks already keep one row per run, and columns that
    nobody asks for are not read."""
    return last_per_key(events, [run], list(order_by))


def _with_status(*statuses: str) -> Column:
    return F.count(F.when(F.col("status").isin(*statuses), 1))


def run_dashboard(runs: DataFrame, duration: Column) -> DataFrame:
    """Counts per state, success rate and mean duration of succeeded runs: one aggregation."""
    total, succeeded = F.count(F.lit(1)), _with_status(SUCCEEDED)
    spent = F.when(F.col("status") == SUCCEEDED, duration)
    return runs.agg(
        total.alias("total_runs"),
        succeeded.alias("succeeded"),
        _with_status(FAILED).alias("failed"),
        _with_status(RETRYING).alias("retrying"),
        _with_status(PENDING, RUNNING).alias("pending_or_running"),
        F.when(total > 0, F.round(F.lit(100.0) * succeeded / total, 2)).alias("success_rate_percent"),
        F.round(F.avg(spent), 4).alias("avg_duration_seconds"),
    )


def runs_in_flight(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status").isin(*IN_FLIGHT))


def latest_failed(runs: DataFrame, order_by: list, n: int = 20) -> DataFrame:
    """The newest failed runs (each task keeps its own top n, the driver merges n per task)."""
    return runs.filter(F.col("status") == FAILED).orderBy(*order_by).limit(n)


def with_dead_letter_flag(runs: DataFrame, dead_letters: DataFrame) -> DataFrame:
    """``has_dead_letter`` per run."""
    dead = dead_letters.select("run_id").distinct().withColumn("__dead", F.lit(True))
    return runs.join(dead, "run_id", "left").withColumn(
        "has_dead_letter", F.col("__dead").isNotNull()
    ).drop("__dead")


def dead_letter_report(dead_letters: DataFrame, runs: DataFrame, pipelines: DataFrame) -> DataFrame:
    """Dead letters with their run and the pipeline's attributes."""
    return dead_letters.join(runs, "run_id", "left").join(pipelines, "pipeline", "left")


def ledger_totals(runs: DataFrame, rows: Column, retries: Column) -> DataFrame:
    """Runs, rows and retries per status."""
    return runs.groupBy("status").agg(
        F.count(F.lit(1)).alias("runs"),
        F.coalesce(F.sum(rows), F.lit(0)).cast("bigint").alias("rows_processed"),
        F.coalesce(F.sum(retries), F.lit(0)).cast("bigint").alias("retries"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables in one plan."""
    counts = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        counts = part if counts is None else counts.unionByName(part)
    return counts


def score_trend(
    scorecards: DataFrame, pipeline: str, order_by: list[str], score: str = "overall_score", *,
    hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """``score_delta`` against the previous scorecard of the same pipeline."""
    pieces = pieces_needed(scorecards, [pipeline], hot_key_rows)
    value = F.col(quoted(score))
    return along_key(
        scorecards, [pipeline], order_by, pieces=pieces,
        previous={"__was": F.struct(value.alias("score"))},
    ).withColumn("score_delta", F.round(value - F.col("__was")["score"], 2)).drop("__was")


def event_rate(events: DataFrame, ts: str, by: list[str], minutes: int = 5) -> DataFrame:
    """Events per second over a window of ``minutes`` that slides by one minute.

    Events collapse to counts per minute first; only those few rows are spread over the windows
    they belong to.
    """
    per_minute = events.groupBy(*by, F.date_trunc("minute", F.col(ts)).alias("__minute")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(minutes)),
        lambda i: F.col("__minute") + F.make_interval(mins=i),
    )
    spread = per_minute.withColumn("window_end", F.explode(ends))
    return spread.groupBy(*by, "window_end").agg(
        (F.sum("__n") / F.lit(60.0 * minutes)).alias("rate_per_second")
    )


def duration_histogram(runs: DataFrame, by: list, duration: Column, bounds=DURATION_BOUNDS) -> DataFrame:
    """Cumulative bucket counts ``(le, n)`` per group; group size is the number of bounds."""
    cumulative = [F.count(F.when(duration <= b, 1)).alias(f"b{i}") for i, b in enumerate(bounds)]
    wide = runs.groupBy(*by).agg(*cumulative, F.count(duration).alias("total"))
    return wide


def duration_quantiles(
    runs: DataFrame, by: list, duration: Column, quantiles=(0.5, 0.95), bounds=DURATION_BOUNDS
) -> DataFrame:
    """Quantiles read off the duration histogram by linear interpolation inside a bucket.

    A quantile in the open-ended bucket is reported as the highest finite bound. One aggregation
    with a fixed number of counters per group, whatever the number of runs.
    """
    wide = duration_histogram(runs, by, duration, bounds)
    names = [c for c in wide.columns if c not in [*[f"b{i}" for i in range(len(bounds))], "total"]]

    def quantile(q: float) -> Column:
        rank = F.lit(q) * F.col("total")
        value = F.lit(float(bounds[-1]))
        for i in reversed(range(len(bounds))):
            low = F.lit(float(bounds[i - 1])) if i else F.lit(0.0)
            below = F.col(f"b{i - 1}") if i else F.lit(0)
            inside = F.col(f"b{i}") - below
            share = (rank - below) / F.when(inside > 0, inside)
            value = F.when(
                F.col(f"b{i}") >= rank, low + (F.lit(float(bounds[i])) - low) * share
            ).otherwise(value)
        return F.when(F.col("total") > 0, value)

    return wide.select(*names, *[quantile(q).alias(f"p{round(q * 100)}") for q in quantiles])
