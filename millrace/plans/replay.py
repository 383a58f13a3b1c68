"""Replay of quarantined rows: corrected rows enter the pipeline again, each once.

A replay writes the rows it takes down under its run id before anything else, so a row belongs to one replay
and a replay that is started again goes on with the same rows. One that fails gives its rows back. Rows that
still break a rule are quarantined anew, as rows of the replay's run. One replay of a dataset at a time.
"""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import EtlError
from millrace.lake import files, layers
from millrace.lake.targets import open_dimension
from millrace.operators.quarantine import ADDED, BROKEN, DIGEST, FLAG, ORIGIN, corrected
from millrace.plans.ingest import DEFAULT_TARGET, PipelineSpec, RunResult, run_ingest
from millrace.sources import register_source


def quarantined(spark: SparkSession, root: str, dataset: str) -> DataFrame | None:
    """Every row that was ever set aside, with its run, the rules it breaks and its digest; None if no run
    ever set one aside."""
    folder = layers.layer_dir(root.rstrip("/"), "checked", dataset)
    folders = files.matches(spark, f"{folder}/dt=*/run_id=*/{FLAG}=true")
    if not folders:
        return None
    return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*folders)


def _folder(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/replays/{dataset}"


def pending(spark: SparkSession, root: str, dataset: str) -> DataFrame | None:
    """The quarantined rows that no replay has taken."""
    rows, folder = quarantined(spark, root, dataset), _folder(root, dataset)
    done = files.matches(spark, f"{folder}/run_id=*/_SUCCESS")
    if rows is None or not done:
        return rows
    taken = spark.read.parquet(*[d.rsplit("/", 1)[0] for d in done]).select(ORIGIN, DIGEST)
    return rows.join(taken, [ORIGIN, DIGEST], "left_anti").select(*rows.columns)


def _replayed(spark: SparkSession, config: dict) -> DataFrame:
    return spark.read.parquet(config["path"]).drop(ORIGIN, *ADDED)


register_source("replay", _replayed)


def replay(
    spark: SparkSession, root: str, spec: PipelineSpec, corrections: DataFrame, run_id: str, now: datetime | None = None
) -> RunResult:
    """Run the pipeline over the corrected rows.

    ``corrections`` has ``_row_digest`` and any of the batch's columns (before renaming), one row per digest.
    """
    folder = f"{_folder(root, spec.dataset)}/run_id={run_id}"
    if not files.exists(spark, f"{folder}/_SUCCESS"):
        if not corrections.groupBy(DIGEST).count().filter("count > 1").isEmpty():
            raise EtlError(f"there are several corrections of one {DIGEST}")
        rows = pending(spark, root, spec.dataset)
        if rows is None:
            raise EtlError(f"no rows of {spec.dataset!r} were set aside")
        corrected(rows, corrections).drop(BROKEN).write.mode("overwrite").parquet(folder)
    again = replace(spec, source={"type": "replay", "path": folder}, incremental=None, quarantine=True)
    try:
        return run_ingest(spark, root, again, run_id, now)
    except Exception:
        target = open_dimension(spark, root.rstrip("/"), spec.target or DEFAULT_TARGET)
        if not target.has_load_of(run_id):
            files.remove(spark, folder)
        raise
