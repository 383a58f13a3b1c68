"""Bronze and silver layers: ``<root>/layers/<layer>/<dataset>/dt=.../run_id=...``.

A run owns one folder, so running it again replaces exactly its own rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.lake import files
from millrace.sources.registry import POSITION

LAYERS = ("bronze", "silver")


def layer_dir(root: str, layer: str, dataset: str) -> str:
    return f"{root}/layers/{layer.lower()}/{dataset}"


def index_dir(root: str, layer: str, dataset: str) -> str:
    return f"{root}/index/{layer.lower()}/{dataset}"


def run_dir(root: str, layer: str, dataset: str, run_id: str, partition_date: date) -> str:
    return f"{layer_dir(root, layer, dataset)}/dt={partition_date.isoformat()}/run_id={run_id}"


def discard_run(
    spark: SparkSession, root: str, layer: str, dataset: str, run_id: str, keep: str | None = None
) -> None:
    """Remove what a run left in a layer on any day, except in the folder to keep."""
    kept = keep and keep.rstrip("/").rsplit("/dt=", 1)[1]
    for folder in files.matches(spark, f"{layer_dir(root, layer, dataset)}/dt=*/run_id={run_id}"):
        if folder.rsplit("/dt=", 1)[1] != kept:
            files.remove(spark, folder)
            files.remove(spark, f"{index_dir(root, layer, dataset)}/dt={folder.rsplit('/dt=', 1)[1]}")


def forget_index(spark: SparkSession, root: str, layer: str, dataset: str, run_id: str) -> None:
    """Take a run out of the index of file ranges, before it writes."""
    for folder in files.matches(spark, f"{index_dir(root, layer, dataset)}/dt=*/run_id={run_id}"):
        files.remove(spark, folder)


def write_layer(
    df: DataFrame, root: str, layer: str, dataset: str, run_id: str, partition_date: date
) -> str:
    """Write one run's batch; returns its folder. No shuffle: tasks write what they computed."""
    folder = run_dir(root, layer, dataset, run_id, partition_date)
    forget_index(df.sparkSession, root, layer, dataset, run_id)
    df.write.mode("overwrite").parquet(folder)
    return folder


def write_layer_by_date(df: DataFrame, root: str, layer: str, dataset: str, run_id: str, dt) -> str:
    """Write a batch that spans many days in one job, replacing only the partitions it touches.

    ``rebalance`` gathers a day's rows into few files and still splits a day that holds far more
    than the others.
    """
    folder = layer_dir(root, layer, dataset)
    forget_index(df.sparkSession, root, layer, dataset, run_id)
    placed = df.withColumns({"dt": dt.cast("date"), "run_id": F.lit(run_id)})
    placed.hint("rebalance", "dt").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("dt", "run_id").parquet(folder)
    return folder


def read_layer(
    spark: SparkSession, root: str, layer: str, dataset: str, schema: str | None = None
) -> DataFrame | None:
    """All runs of a layer with ``dt`` and ``run_id``; None when nothing was written yet.

    Columns that only some runs have are NULL elsewhere. Merging schemas opens every footer; for a
    layer of very many files pass the ``schema`` (DDL) known to the catalog instead.
    """
    folder = layer_dir(root, layer, dataset)
    if not files.child_folders(spark, folder):
        return None
    reader = spark.read.option("basePath", folder)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    try:
        return reader.parquet(folder).drop(POSITION)
    except AnalysisException as exc:
        # Every run so far was blocked, so there are folders but no file.
        if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def preview(df: DataFrame | None, limit: int = 100) -> list[dict]:
    """The first rows found, as dictionaries; ``limit`` bounds what reaches the driver."""
    return [] if df is None else [row.asDict(recursive=True) for row in df.limit(limit).collect()]
