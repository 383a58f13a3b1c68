"""Running baselines as keyed state of a stream: one state per dataset and column.

Each task of a micro-batch, of however many files, first sums up what it read of a column (count, mean and squared
deviations), so what is shuffled is one row per task and column, also where one dataset has most of the
rows. The state of a key takes these rows in, and tells, as a batch run does, how far the new rows' mean lies
from the baseline before them. Keys are kept for good: a state is three numbers. (Timers by processing time
would let idle ones go, but a query that has them never ends by itself, as one that polls has to.)
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.types import measurable_columns, quoted
from millrace.operators.statistics import MIN_BASELINE_SAMPLES, Z_THRESHOLD
from millrace.operators.transform import last_per_key
from millrace.session import ship_package

MOMENTS = "dataset string, column string, count bigint, mean double, m2 double"
RESULT = f"{MOMENTS}, value double, z_score double, is_anomaly boolean"
_NAMES = ["dataset", "column", "count", "mean", "m2", "value", "z_score", "is_anomaly"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def merged_moments(a: tuple[int, float, float], b: tuple[int, float, float]) -> tuple[int, float, float]:
    """(count, mean, squared deviations) of two sets of values together."""
    (n, mean, m2), (k, other, more) = a, b
    total = n + k
    if not total:
        return 0, 0.0, 0.0
    shift = other - mean
    return total, mean + shift * k / total, m2 + more + shift * shift * n * k / total


def task_moments(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What one task read, as one row per dataset and column."""
    found: dict[tuple[str, str], tuple[int, float, float]] = {}
    for part in parts:
        for dataset, rows in part.groupby("dataset"):
            for column in rows.columns.drop("dataset"):
                values = rows[column].to_numpy(dtype=float, na_value=np.nan)
                values = values[~np.isnan(values)]
                if len(values):
                    here = (len(values), float(values.mean()), float(((values - values.mean()) ** 2).sum()))
                    found[dataset, column] = merged_moments(found.get((dataset, column), (0, 0.0, 0.0)), here)
    yield pd.DataFrame([(*key, *moments) for key, moments in found.items()], columns=_NAMES[:5])


class Baseline(StatefulProcessor):
    """The state of one dataset's column."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.moments = handle.getValueState("moments", "count bigint, mean double, m2 double")

    def _known(self) -> tuple[int, float, float]:
        return tuple(self.moments.get()) if self.moments.exists() else (0, 0.0, 0.0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before, new = self._known(), (0, 0.0, 0.0)
        for part in rows:
            # In a fixed order, so that a repeated batch gives the same sums.
            ordered = part.sort_values(["count", "mean", "m2"])
            for n, mean, m2 in zip(ordered["count"], ordered["mean"], ordered["m2"], strict=True):
                new = merged_moments(new, (int(n), float(mean), float(m2)))
        after = merged_moments(before, new)
        self.moments.update(after)
        n, mean, m2 = before
        spread = (m2 / n) ** 0.5 if n else 0.0
        z = (new[1] - mean) / spread if n >= MIN_BASELINE_SAMPLES and spread > 0 else None
        row = pd.DataFrame([(*key, *after, new[1], z, z is not None and abs(z) > Z_THRESHOLD)], columns=_NAMES)
        yield row.astype({"z_score": "float64"})

    def close(self) -> None:
        pass


def keyed_baselines(stream: DataFrame, dataset: str) -> DataFrame:
    """A stream of the changed baselines; ``dataset`` names the column that tells datasets apart.

    Rows without a dataset count to none. NULL and NaN are no values.
    """
    name = F.col(quoted(dataset))
    columns = measurable_columns(stream, exclude=(dataset,))
    rows = stream.filter(name.isNotNull()).select(
        name.cast("string").alias("dataset"), *[F.col(quoted(c)).cast("double").alias(c) for c in columns if c != "dataset"]
    )
    ship_package(stream.sparkSession)
    return rows.mapInPandas(task_moments, MOMENTS).groupBy("dataset", "column").transformWithStateInPandas(
        Baseline(), RESULT, "update", "none"
    )


@contextmanager
def _state_store(spark: SparkSession):
    """Queries started in here keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def collect_baselines(changed: DataFrame, checkpoint: str, folder: str) -> DataFrame:
    """Run the stream over all that has arrived and return the newest baseline of every key; ``folder``
    keeps all that was told, by micro-batch, so a repeated one replaces what it wrote."""
    spark = changed.sparkSession

    def keep(rows: DataFrame, batch_id: int) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    with _state_store(spark):
        changed.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(
            availableNow=True
        ).start().awaitTermination()
    told = spark.read.schema(f"{RESULT}, batch bigint").parquet(folder)
    return last_per_key(told, ["dataset", "column"], ["batch"]).drop("batch")
