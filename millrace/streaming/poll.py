"""Poll a folder for new files and hand each micro-batch to a sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

Sink = Callable[[DataFrame, int], None]


def poll_files(
    spark: SparkSession, file_format: str, schema: StructType, path: str, checkpoint: str, sink: Sink,
    options: dict | None = None, max_files_per_batch: int | None = None,
) -> None:
    """Process everything that arrived since the last call, then stop.

    The checkpoint remembers which files were handed over. A batch that failed half-way is handed
    over again under the same number, so sinks write to a place named after that number or load
    idempotently.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    query = (
        reader.load(path).writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
