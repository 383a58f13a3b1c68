"""Rows of a stream admitted once: re-delivered files and late rows give the table of one clean pass.

``dropDuplicatesWithinWatermark`` keeps the keys of the last while only, so its state stays bounded; a row behind the
watermark is not looked at, whether it is new or came before. Such rows are looked up afterwards: each
arrival is compared with what was admitted on its day, and what is in neither table goes to a side table of late
rows. Both tables are written by micro-batch number, so a repeated batch replaces what it wrote.

``<folder>/main/batch=N/day=..`` has the rows admitted in time, ``<folder>/late/batch=N/day=..`` the late ones.
Rows of one key have one event time; of rows of a key that differ otherwise one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.lake import files

DAY = "__day"


def _table(spark: SparkSession, folder: str, part: str, like: DataFrame) -> DataFrame:
    """All rows of a part, with their day."""
    schema = f"{like._jdf.schema().toDDL()}, `batch` bigint, `{DAY}` date"
    if not files.child_folders(spark, f"{folder}/{part}"):
        return like.sparkSession.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{part}")


def _write(rows: DataFrame, ts: str, folder: str, part: str, batch_id: int) -> None:
    placed = rows.withColumn(DAY, F.to_date(F.col(quoted(ts))))
    placed.write.mode("overwrite").partitionBy(DAY).parquet(f"{folder}/{part}/batch={batch_id}")


def _run(stream: DataFrame, sink, checkpoint: str) -> None:
    stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start().awaitTermination()


def _without(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are not known; NULLs are keys like others."""
    named = known.select(*[F.col(quoted(k)).alias(f"__known_{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(quoted(k)).eqNullSafe(F.col(f"__known_{i}"))
    return rows.join(named, same, "left_anti")


def admit_once(
    stream: DataFrame, keys: list[str], ts: str, lateness: str, checkpoint: str, folder: str
) -> DataFrame:
    """Run over all that has arrived and return every row ever admitted, each key once.

    ``ts`` is a timestamp without NULLs, or rows without one are admitted as late. ``lateness`` is how long a key is
    remembered, such as '1 hour'.
    """
    spark = stream.sparkSession
    columns = stream.columns
    timed = stream.filter(F.col(quoted(ts)).isNotNull())
    fresh = timed.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)
    _run(fresh, lambda rows, n: _write(rows, ts, folder, "main", n), f"{checkpoint}/main")

    def look_up(rows: DataFrame, batch_id: int) -> None:
        """The arrivals of a batch that neither table has; only the days they are of are read."""
        session = rows.sparkSession
        arrived = rows.dropDuplicates(keys).withColumn(DAY, F.to_date(F.col(quoted(ts))))
        days = [r.d for r in arrived.select(F.col(DAY).alias("d")).distinct().collect()]
        on_days = F.col(DAY).isin([d for d in days if d is not None]) | (F.col(DAY).isNull() if None in days else F.lit(False))
        admitted = _table(session, folder, "main", rows).filter(on_days)
        late = _table(session, folder, "late", rows).filter(on_days & (F.col("batch") < batch_id))
        lacking = _without(_without(arrived, admitted, keys), late, keys)
        _write(lacking.select(*[F.col(quoted(c)) for c in columns]), ts, folder, "late", batch_id)

    _run(stream, look_up, f"{checkpoint}/late")
    main, late = (_table(spark, folder, part, stream) for part in ("main", "late"))
    # A file that came between the two passes was admitted as late first and is met by the next run in time.
    return main.unionByName(_without(late, main, keys)).select(*[F.col(quoted(c)) for c in columns])
