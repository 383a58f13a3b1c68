"""Append-only state tables: ledger, scorecards, dead letters, watermarks, catalog.

Rows are written by the driver, a handful per run. Nothing is updated in place: the present value
of anything is its newest row.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.lake import files
from millrace.operators import ledger, lineage, sketches
from millrace.operators.ledger import run_current_state
from millrace.operators.relations import Model
from millrace.operators.transform import last_per_key
from millrace.session import local_frame

CHECKS = (
    "array<struct<rule_type:string,passed:boolean,severity:string,message:string,"
    "violation_count:bigint,checked_count:bigint>>"
)
COLUMNS = "array<struct<name:string,dtype:string>>"
RENAMES = "array<struct<from:string,to:string>>"

SCHEMAS = {
    "run_events": (
        "run_id string, pipeline string, dataset string, status string, event_ts timestamp, seq int,"
        " started_at timestamp, finished_at timestamp, metrics map<string,double>,"
        " logs array<string>, error string, traceback string, retry_count int"
    ),
    "dead_letters": "run_id string, error string, traceback string, created_at timestamp",
    "watermarks": "pipeline string, value string, kind string, run_id string, recorded_at timestamp",
    "batches": (
        "run_id string, started_at timestamp, bronze string, silver string, rows_extracted bigint, hidden array<string>,"
        " watermark string, new_watermark string, kind string, clean_stats map<string,bigint>, recorded_at timestamp"
    ),
    "scorecards": (
        "run_id string, pipeline string, completeness double, consistency double, accuracy double,"
        f" overall_score double, passed boolean, checks {CHECKS}, created_at timestamp"
    ),
    "datasets": "name string, created_at timestamp",
    "schema_versions": (
        f"dataset string, run_id string, version int, columns {COLUMNS}, added_columns array<string>,"
        f" removed_columns array<string>, renamed_columns {RENAMES}, is_drift boolean,"
        " type_changes array<string>, created_at timestamp"
    ),
    "column_sightings": "dataset string, name string, dtype string, run_id string, seen_at timestamp",
    "column_stats": (
        "dataset string, column string, count bigint, mean double, m2 double, run_id string,"
        " recorded_at timestamp"
    ),
    "column_sketches": (
        "dataset string, run_id string, recorded_at timestamp, column string, n bigint, quantiles binary, distinct binary"
    ),
    "anomalies": (
        "dataset string, run_id string, column string, value double, baseline_mean double,"
        " baseline_stddev double, z_score double, created_at timestamp"
    ),
    "lineage": (
        "pipeline string, from_layer string, from_name string, to_layer string, to_name string,"
        f" column_mapping {RENAMES}, recorded_at timestamp"
    ),
}

# Tables that a run reads for one pipeline or dataset lie in folders by it, so that it opens the
# files of its own history only.
FOLDERS = {
    "watermarks": "pipeline",
    "schema_versions": "dataset",
    "column_sightings": "dataset",
    "column_stats": "dataset",
    "column_sketches": "dataset",
    "batches": "run_id",
    "run_events": "pipeline",
    "scorecards": "pipeline",
    "lineage": "pipeline",
    "anomalies": "dataset",
}


class State:
    """The state tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root}/state"

    def folder(self, table: str) -> str:
        return f"{self.root}/{table}"

    def append(self, table: str, rows: list[dict]) -> None:
        if not rows:
            return
        self.recover(table)
        # Keys that the table does not have are left out, missing ones become NULL.
        frame = local_frame(self.spark, rows, SCHEMAS[table])
        writer = frame.coalesce(1).write.mode("append")
        if table in FOLDERS:
            writer = writer.partitionBy(FOLDERS[table])
        writer.parquet(self.folder(table))

    def append_all(self, pending: list[tuple[str, list[dict]]]) -> None:
        """Several tables at once; the jobs are tiny and run side by side."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            for done in [pool.submit(self.append, table, rows) for table, rows in pending]:
                done.result()

    def read(self, table: str) -> DataFrame:
        if not self.recover(table):
            return local_frame(self.spark, [], SCHEMAS[table])
        return self.spark.read.schema(SCHEMAS[table]).parquet(self.folder(table))

    def latest(self, table: str, keys: list[str], order_by: str) -> DataFrame:
        """The newest row per key."""
        return last_per_key(self.read(table), keys, [order_by])

    # Present values that a run starts from; each is one row per pipeline or dataset.

    def watermark(self, pipeline: str):
        mine = self.read("watermarks").filter(F.col("pipeline") == pipeline)
        return mine.agg(F.max_by(F.struct("value", "kind"), "recorded_at").alias("s")).first().s

    def layer_schema(self, dataset: str) -> str:
        """DDL of a bronze layer from the columns ever seen in it, so that reading the layer needs
        no file footers."""
        seen = self.latest("column_sightings", ["dataset", "name"], "seen_at")
        columns = seen.filter(F.col("dataset") == dataset).orderBy("name").collect()
        return ", ".join([f"{quoted(c.name)} {c.dtype}" for c in columns] + ["dt date", "run_id string"])

    def has_dataset(self, dataset: str) -> bool:
        return not self.read("datasets").filter(F.col("name") == dataset).isEmpty()

    def schema_version(self, dataset: str):
        mine = self.read("schema_versions").filter(F.col("dataset") == dataset)
        return mine.agg(F.max_by(F.struct("version", "columns"), "version").alias("s")).first().s

    def baseline(self, dataset: str, before_run: str | None = None) -> DataFrame:
        """Newest baseline per column. A run that is started again passes its id, so that what it
        merged the first time is not counted twice."""
        stats = self.read("column_stats").filter(F.col("dataset") == dataset)
        if before_run is not None:
            stats = stats.filter(F.col("run_id") != before_run)
        newest = last_per_key(stats, ["dataset", "column"], ["recorded_at"])
        return newest.select("dataset", "column", "count", "mean", "m2")

    def batch(self, run_id: str):
        """The batch that an earlier attempt of the run pinned, or None."""
        self.recover("batches")
        folder = f"{self.folder('batches')}/run_id={run_id}"
        if not files.exists(self.spark, folder):
            return None
        schema = SCHEMAS["batches"].removeprefix("run_id string, ")
        rows = self.spark.read.schema(schema).parquet(folder)
        return rows.orderBy(F.desc("recorded_at")).first()

    def unpin(self, run_id: str) -> None:
        files.remove(self.spark, f"{self.folder('batches')}/run_id={run_id}")

    # What the runs wrote, ready to be served.

    def model(self) -> Model:
        """The state tables with what refers to what, for filters such as ``dataset__name`` and
        ``run__pipeline``; runs are in their present state."""
        tables: dict = {name: (lambda name=name: self.read(name)) for name in SCHEMAS}
        model = Model({**tables, "runs": self.runs})
        for table in ("schema_versions", "column_sightings", "column_stats", "anomalies", "runs"):
            model.refers(table, "dataset", "dataset", "datasets", "name", reverse=table)
        for table, reverse in (
            ("scorecards", "scorecard"), ("dead_letters", "dead_letter"), ("anomalies", "anomalies"),
            ("schema_versions", "schema_versions"), ("run_events", "events"),
        ):
            model.refers(table, "run", "run_id", "runs", "run_id", reverse=reverse)
        return model

    def served(self, table: str, **conditions) -> DataFrame:
        """The rows of a state table that fit conditions on its columns and along its relations."""
        return self.model().filtered(table, **conditions)

    def runs(self) -> DataFrame:
        """The present state of every run."""
        return run_current_state(self.read("run_events"))

    def dashboard(self) -> DataFrame:
        """Counts by state, success rate and mean duration of all runs, as one row."""
        return ledger.run_dashboard(self.runs(), F.col("metrics")["duration_seconds"])

    def failed_runs(self, n: int = 20) -> DataFrame:
        """The newest failed runs, newest first, with whether they have a dead letter."""
        order = [F.desc("event_ts"), F.desc("run_id")]
        newest = ledger.latest_failed(self.runs(), order, n)
        return ledger.with_dead_letter_flag(newest, self.read("dead_letters")).orderBy(*order)

    def score_trend(self) -> DataFrame:
        """Every scorecard with what its overall score differs by from the pipeline's one before."""
        return ledger.score_trend(self.read("scorecards"), "pipeline", ["created_at", "run_id"])

    def sketches(self, dataset: str, since=None, until=None) -> DataFrame:
        """The column sketches of a dataset's runs, recorded from ``since`` to before ``until``; a run that was
        recorded twice counts once."""
        rows = self.read("column_sketches").filter(F.col("dataset") == dataset)
        if since is not None:
            rows = rows.filter(F.col("recorded_at") >= F.lit(since))
        if until is not None:
            rows = rows.filter(F.col("recorded_at") < F.lit(until))
        return last_per_key(rows, ["run_id", "column"], ["recorded_at"])

    def column_quantiles(self, dataset: str, ranks: list[float], since=None, until=None) -> DataFrame:
        """(column, n, p..) over all rows of the runs in the range."""
        return sketches.quantiles(self.sketches(dataset, since, until), ["column"], ranks)

    def values_new_in(self, dataset: str, run_id: str) -> DataFrame:
        """(column, distinct_values, new_values) of a run: how many values no other run had."""
        rows = self.sketches(dataset)
        mine = F.col("run_id") == run_id
        return sketches.new_values(rows.filter(~mine), rows.filter(mine), ["column"])

    def drift_history(self, dataset: str) -> DataFrame:
        """Schema versions of a dataset, oldest first."""
        return self.read("schema_versions").filter(F.col("dataset") == dataset).orderBy("version")

    def unusual_columns(self, dataset: str) -> DataFrame:
        """Columns whose mean left its baseline, newest first."""
        return self.read("anomalies").filter(F.col("dataset") == dataset).orderBy(F.desc("created_at"), "column")

    def lineage_edges(self) -> DataFrame:
        """The edges of all pipelines as they were recorded last."""
        return lineage.latest_edges(self.read("lineage"))

    def lineage_graph(self, dataset: str) -> dict:
        return lineage.lineage_graph(self.lineage_edges(), dataset)

    def recover(self, table: str) -> bool:
        """Put a table back that a compaction had set aside when it died; whether there is a table."""
        if files.exists(self.spark, self.folder(table)):
            return True
        aside = f"{self.root}/.replaced-{table}"
        if files.exists(self.spark, aside):
            files.rename(self.spark, aside, self.folder(table))
            return True
        return False

    def compact(self, table: str) -> None:
        """Put the many small files of a table into one per folder, for tables of many runs.

        The rows are written to a new folder first; then the old one is set aside and the new one takes its
        place. At each moment all rows are in one of these folders, and whoever finds the table missing
        puts the one set aside back. No run may be under way meanwhile.
        """
        fresh, aside, folder = f"{self.root}/.compacted-{table}", f"{self.root}/.replaced-{table}", self.folder(table)
        if not self.recover(table):
            return
        files.remove(self.spark, aside)  # of a compaction that died after all was in place
        rows = self.read(table)
        if table in FOLDERS:
            rows = rows.repartition(FOLDERS[table])
            rows.write.mode("overwrite").partitionBy(FOLDERS[table]).parquet(fresh)
        else:
            rows.coalesce(1).write.mode("overwrite").parquet(fresh)
        files.rename(self.spark, folder, aside)
        files.rename(self.spark, fresh, folder)
        files.remove(self.spark, aside)
