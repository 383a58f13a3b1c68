"""Sliding event rates on an unbounded stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.transform import last_per_key


def stream_rate(
    events: DataFrame, ts: str, by: list[str], lateness: str = "10 minutes", minutes: int = 5
) -> DataFrame:
    """Events per second over sliding windows; state older than the lateness is dropped.

    The batch form is ``millrace.operators.ledger.event_rate``; here the window assignment has to
    stay inside the one stateful aggregation.
    """
    windows = F.window(ts, f"{minutes} minutes", "1 minute")
    counted = events.withWatermark(ts, lateness).groupBy(*by, windows.alias("w")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counted.select(
        *by, F.col("w.end").alias("window_end"), (F.col("n") / F.lit(60.0 * minutes)).alias("rate_per_second")
    )


def collect_rates(rates: DataFrame, keys: list[str], checkpoint: str, folder: str) -> DataFrame:
    """Run the stream over all that has arrived and return the newest rate of every window.

    Each micro-batch writes the windows it changed under its own number, so a repeated batch replaces
    what it wrote and no window waits for a later event to be seen.
    """

    def keep(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    rates.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()
    schema = f"{rates._jdf.schema().toDDL()}, batch bigint"
    written = rates.sparkSession.read.schema(schema).parquet(folder)
    return last_per_key(written, keys, ["batch"]).drop("batch")
