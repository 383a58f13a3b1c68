"""Running column baselines over a stream of batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.lake import files
from millrace.operators.statistics import STATS_SCHEMA, column_moments, judge_and_merge
from millrace.session import local_frame
from millrace.streaming.poll import poll_files


# So many states are kept, the newest: a batch that is repeated starts from the one before it.
KEPT_STATES = 3


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted((int(f.split("=", 1)[1]) for f in files.child_folders(spark, folder)), reverse=True)


def _state(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The newest baseline, or the newest one older than a batch."""
    for n in _numbers(spark, folder):
        if (before is None or n < before) and files.exists(spark, f"{folder}/batch={n}/_SUCCESS"):
            return spark.read.parquet(f"{folder}/batch={n}")
    return local_frame(spark, [], STATS_SCHEMA)


def stream_baseline(
    spark: SparkSession, file_format: str, schema: StructType, path: str, checkpoint: str,
    state_folder: str, dataset: str,
) -> DataFrame:
    """Merge every new file into the baseline of its columns and return the result.

    Each micro-batch writes the whole baseline (one row per column) under its own number, with the
    verdict on that batch; a repeated batch starts from the state before it, so it counts once. Older
    states are removed, so what is listed stays small however many files arrive.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        moments = column_moments(batch).select(F.lit(dataset).alias("dataset"), "*")
        baseline = _state(session, state_folder, before=batch_id).select("dataset", "column", "count", "mean", "m2")
        judge_and_merge(moments, baseline, ["dataset", "column"]).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{state_folder}/batch={batch_id}")
        for old in _numbers(session, state_folder)[KEPT_STATES:]:
            files.remove(session, f"{state_folder}/batch={old}")

    poll_files(spark, file_format, schema, path, checkpoint, merge, max_files_per_batch=1)
    return _state(spark, state_folder)
