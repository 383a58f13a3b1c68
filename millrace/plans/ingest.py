"""One ingest run: extract, narrow to new rows, clean, validate, reshape, load, record.

Passes over the batch:

1. source -> bronze folder: incremental filter, cleaning and all counters in one job;
2. bronze -> one aggregation that answers every row-level rule and the column statistics
   (plus one job for rules that compare rows, if there are any);
3. bronze -> silver folder;
4. silver -> next snapshot of the target.

The driver keeps specs, counters and catalog rows only. Everything a run writes lies under its run
id and becomes current last, so a run that died is simply started again with the same id. Its first
attempt pins the batch (where bronze is, its counters, the watermark it leads to); later ones go on from
there and never read the source again, unless the attempt failed before anything was loaded.
"""

from __future__ import annotations

import time
import traceback as tb
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from millrace.errors import EtlError, ExtractError, TransformError, ValidationFailed, first_line
from millrace.functions.types import measurable_columns, nan_to_null, quoted
from millrace.lake import files, layers, targets
from millrace.lake.skipping import PLACES, IndexedLayer, default_columns, index_run, indexed_source
from millrace.lake.state import State
from millrace.operators.clean import clean_observed
from millrace.operators.drift import columns_of, diff_schema
from millrace.operators.incremental import (
    advance_watermark, newer_than, watermark_kind, watermark_max,
)
from millrace.operators.ledger import FAILED, RETRYING, RUNNING, SUCCEEDED
from millrace.operators.lineage import pipeline_edges
from millrace.operators.quarantine import ADDED, FLAG, excused, with_broken_rules
from millrace.operators.scorecard import ValidationOutcome, assess, gate
from millrace.operators.sketches import sketch_aggregates
from millrace.operators.statistics import STATS_SCHEMA, judge_and_merge, moment_aggregates
from millrace.operators.transform import transform
from millrace.session import configure, local_frame
from millrace.sources import POSITION, extract

# Sources whose format cannot skip rows by a filter: their rows are counted while they are read. Of the
# others they are counted by a job of its own, which for Parquet reads footers only.
UNFILTERED_SOURCES = ("file", "s3", "rest_api")


DEFAULT_TARGET = "customers"


@dataclass
class PipelineSpec:
    """A configured pipeline.

    ``transform`` may hold ``clean`` besides the reshape steps. ``order_by`` names the columns of
    the reshaped batch that order its rows; CSV and paged sources know their row order themselves.
    Without a ``target`` rows go to the default one. ``keep_raw`` also writes the new rows as they
    were before cleaning. ``rows_extracted`` counts the source's rows before the watermark's filter;
    ``count_source=False`` saves that count. With ``quarantine`` the rows that break a blocking rule are set
    aside with the rules they break, and the others are loaded; rules that compare rows still block. ``sketches`` keeps mergeable
    quantiles and distinct counts of every column, from the scan that judges the rules.
    """

    name: str
    source: dict
    source_name: str = ""
    target: str | None = None
    validation: dict = field(default_factory=dict)
    transform: dict = field(default_factory=dict)
    incremental: dict | None = None
    order_by: list[str] = field(default_factory=list)
    count_source: bool | None = None
    keep_raw: bool = False
    quarantine: bool = False
    sketches: bool = False

    @property
    def dataset(self) -> str:
        """Name in the catalog and the layers: the target if one is named, else the pipeline."""
        return self.target or self.name

    @property
    def renames(self) -> dict[str, str]:
        return self.transform.get("rename") or {}


@dataclass
class RunResult:
    run_id: str
    status: str
    rows_extracted: int | None = None
    rows_loaded: int = 0
    rows_quarantined: int | None = None
    clean_stats: dict = field(default_factory=dict)
    load_result: dict = field(default_factory=dict)
    validation: ValidationOutcome | None = None
    new_watermark: str | None = None
    step_logs: list[str] = field(default_factory=list)
    duration_seconds: float = 0.0
    error: str = ""

    def metrics(self) -> dict[str, float]:
        """Flat numbers for the ledger."""
        found = {
            "rows_extracted": self.rows_extracted, "rows_loaded": self.rows_loaded,
            "rows_quarantined": self.rows_quarantined, "duration_seconds": self.duration_seconds,
            **{f"clean.{k}": v for k, v in self.clean_stats.items()}, **self.load_result,
        }
        return {k: float(v) for k, v in found.items() if v is not None}


class IngestRun:
    """A single attempt at a run."""

    def __init__(self, spark: SparkSession, root: str, spec: PipelineSpec, run_id: str, now: datetime):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.spec = spec
        self.now = now
        self.target = spec.target or DEFAULT_TARGET
        self.state = State(spark, self.root)
        self.result = RunResult(run_id, RUNNING)
        self.bronze = layers.run_dir(self.root, "bronze", spec.dataset, run_id, now.date())
        self.silver = layers.run_dir(self.root, "silver", spec.dataset, run_id, now.date())
        self.checked = layers.run_dir(self.root, "checked", spec.dataset, run_id, now.date())
        self.kind = None
        self.watermark = None
        self.hidden: tuple[str, ...] = ()
        self.loaded = False
        self.pinned = self.state.batch(run_id)
        if self.pinned is not None:
            self.now = self.pinned.started_at.replace(tzinfo=timezone.utc)
            self.bronze, self.silver = self.pinned.bronze, self.pinned.silver
            self.checked = layers.run_dir(self.root, "checked", spec.dataset, run_id, self.now.date())

    def log(self, text: str) -> None:
        self.result.step_logs.append(text)

    # -- stages ---------------------------------------------------------------------------------

    def stage_delta(self) -> DataFrame:
        """Write the new, cleaned rows to this run's bronze folder and read them back.

        An earlier attempt's batch is taken as it is.
        """
        spec, result = self.spec, self.result
        if self.pinned is not None:
            pin = self.pinned
            self.hidden, self.watermark, self.kind = tuple(pin.hidden), pin.watermark, pin.kind
            result.rows_extracted, result.new_watermark = pin.rows_extracted, pin.new_watermark
            result.clean_stats = dict(pin.clean_stats or {})
            self.log(f"went on with the batch pinned at {pin.recorded_at}")
            return self.spark.read.parquet(self.bronze)
        source_type = spec.source.get("type")
        raw = nan_to_null(extract(self.spark, source_type, spec.source))
        self.hidden = (POSITION,) if POSITION in raw.columns else ()
        wanted = spec.count_source is not False
        count_source = wanted and (source_type or "").lower() in UNFILTERED_SOURCES
        everything, delta, cleaned = Observation(), Observation(), Observation()
        layer = indexed_source(self.spark, spec.source) if (source_type or "").lower() == "layer" else None
        # The predicate may probe the source, so it is made before anything is observed.
        column, newer = self._newer_rows(raw, layer)
        batch = raw.observe(everything, F.count(F.lit(1)).alias("rows")) if count_source else raw
        if newer is not None and layer is not None:
            # Of a layer only the files are opened that can have new rows.
            grace = (spec.incremental or {}).get("grace_seconds", 0)
            batch = layer.newer(column, self.watermark, grace, self.kind).drop(*PLACES)
        elif newer is not None:
            batch = batch.filter(newer)
        newest = (
            watermark_max(batch, column) if column else F.max(F.lit(None).cast("string"))
        ).alias("newest")
        batch = batch.observe(delta, F.count(F.lit(1)).alias("rows"), newest)
        if spec.keep_raw:
            layers.write_layer(
                batch, self.root, "raw", spec.dataset, result.run_id, self.now.date()
            )
            batch = self.spark.read.parquet(
                layers.run_dir(self.root, "raw", spec.dataset, result.run_id, self.now.date())
            )
        clean_spec = spec.transform.get("clean")
        if clean_spec:
            batch = clean_observed(batch, clean_spec, cleaned, hidden=self.hidden)
        layers.forget_index(self.spark, self.root, "bronze", spec.dataset, result.run_id)
        try:
            batch.write.mode("overwrite").parquet(self.bronze)
        except PySparkException as exc:
            raise ExtractError(f"reading the source failed: {first_line(exc)}") from exc
        found = delta.get
        if wanted:
            counted = layer.count if layer is not None else raw.count
            result.rows_extracted = everything.get["rows"] if count_source else counted()
        self.log(f"extracted {result.rows_extracted} row(s) from {source_type}")
        if column:
            dtype = raw.schema[column].dataType
            result.new_watermark = advance_watermark(
                self.spark, self.watermark, found["newest"], dtype, self.kind
            )
            self.log(
                f"{found['rows']} new row(s) by {column!r}, watermark"
                f" {self.watermark!r} -> {result.new_watermark!r}"
            )
        if clean_spec:
            names = ("cells_trimmed", "cells_lowercased", "cells_filled", "rows_dropped")
            result.clean_stats = {n: int(cleaned.get.get(n) or 0) for n in names}
            self.log(f"cleaned: {result.clean_stats}")
        self.state.append("batches", [{
            "run_id": result.run_id, "started_at": self.now, "bronze": self.bronze, "silver": self.silver,
            "rows_extracted": result.rows_extracted, "hidden": list(self.hidden),
            "watermark": None if self.watermark is None else str(self.watermark),
            "new_watermark": result.new_watermark, "kind": self.kind, "clean_stats": result.clean_stats,
            "recorded_at": datetime.now(timezone.utc),
        }])
        return self.spark.read.parquet(self.bronze)

    def _newer_rows(self, raw: DataFrame, layer: IndexedLayer | None) -> tuple[str | None, Column | None]:
        """The watermark column, if the batch has one, and the predicate for new rows."""
        config = self.spec.incremental or {}
        column = config.get("column")
        if not column or column not in raw.columns:
            return None, None
        stored = self.state.watermark(self.spec.name)
        self.watermark = stored.value if stored else config.get("initial_value")
        self.kind = (stored.kind if stored else None) or config.get("kind")
        if not self.watermark:
            self.kind = self.kind or watermark_kind(raw, column, None)
            return column, None
        self.watermark = str(self.watermark)
        if layer is not None:
            self.kind = layer.kind(column, self.watermark, raw.schema[column].dataType)
        else:
            self.kind = watermark_kind(raw, column, self.watermark)
        grace = config.get("grace_seconds", 0)
        return column, newer_than(raw, column, self.watermark, grace, self.kind)

    def check(self, batch: DataFrame) -> ValidationOutcome:
        """Rules, scores and column statistics of the staged rows; the gate comes after."""
        visible = [c for c in measurable_columns(batch) if c not in self.hidden]
        extra = moment_aggregates(batch, visible)
        if self.spec.sketches:
            extra += sketch_aggregates(batch, [c for c in batch.columns if c not in self.hidden])
        outcome = assess(batch, self.spec.validation, self.now, self.hidden, tuple(extra))
        self.result.validation = outcome
        rules = self.spec.validation.get("rules", [])
        gate(outcome, excused(batch, rules, self.now, self.hidden) if self.spec.quarantine else frozenset())
        self.log(f"validated: overall score {outcome.overall_score}")
        return outcome

    def set_aside(self, batch: DataFrame, outcome: ValidationOutcome) -> DataFrame:
        """The rows that go on; those that break a blocking rule stay in the checked layer.

        Both are written by one job, as partitions of the run's folder. Without broken rows nothing is written.
        """
        if not self.spec.quarantine:
            return batch
        self.result.rows_quarantined = 0
        if outcome.passed:
            return batch
        counted = Observation()
        rules = self.spec.validation.get("rules", [])
        marked = with_broken_rules(batch, rules, self.result.run_id, self.now, self.hidden)
        marked.observe(counted, F.count(F.when(F.col(FLAG), 1)).alias("rows")).write.mode("overwrite").partitionBy(
            FLAG
        ).parquet(self.checked)
        self.result.rows_quarantined = counted.get["rows"]
        self.log(f"set aside {self.result.rows_quarantined} row(s)")
        checked = self.spark.read.schema(marked.schema).parquet(self.checked)
        return checked.filter(~F.col(FLAG)).drop(*ADDED)

    def reshape(self, batch: DataFrame) -> DataFrame:
        spec = self.spec
        order = self._order(batch)
        reshaped = transform(batch, spec.transform, order or None, self.hidden)
        loaded = Observation()
        layers.forget_index(self.spark, self.root, "silver", spec.dataset, self.result.run_id)
        try:
            reshaped.observe(loaded, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(
                self.silver
            )
        except PySparkException as exc:
            raise TransformError(f"reshaping failed: {first_line(exc)}") from exc
        self.result.rows_loaded = loaded.get["rows"]
        visible = [c for c in reshaped.columns if c not in self.hidden]
        self.log(f"reshaped to {self.result.rows_loaded} row(s), {len(visible)} column(s)")
        return self.spark.read.parquet(self.silver)

    def _order(self, batch: DataFrame) -> list:
        if self.spec.order_by:
            return [F.col(quoted(c)) for c in self.spec.order_by]
        return [F.col(POSITION)] if POSITION in batch.columns else []

    def load(self, batch: DataFrame) -> None:
        order = list(self.spec.order_by) or [c for c in (POSITION,) if c in batch.columns]
        if not order:
            # Without any stated order all columns together give a repeatable one.
            order = [f.name for f in batch.schema if not isinstance(f.dataType, (MapType, VariantType))]
        self.result.load_result = targets.load(
            self.spark, self.root, self.target, batch, order, self.now,
            self.result.run_id,
        )
        self.loaded = True
        self.log(f"loaded: {self.result.load_result}")

    def discard_layers(self, older_days_only: bool = False) -> None:
        """Take this run's rows out of the layers: what an earlier attempt left under another day,
        or, after a failure, everything."""
        for layer, folder in (
            ("raw", None), ("bronze", self.bronze), ("checked", self.checked), ("silver", self.silver)
        ):
            keep = folder if older_days_only else None
            layers.discard_run(self.spark, self.root, layer, self.spec.dataset, self.result.run_id, keep)

    # -- bookkeeping ----------------------------------------------------------------------------

    def event(self, status: str, finished: datetime | None = None, trace: str = "", retry_count: int = 0):
        r = self.result
        r.status = status
        self.state.append("run_events", [{
            "run_id": r.run_id, "pipeline": self.spec.name, "dataset": self.spec.dataset,
            "status": status, "event_ts": datetime.now(timezone.utc), "started_at": self.now,
            "seq": {RUNNING: 1, RETRYING: 2}.get(status, 3),
            "finished_at": finished, "metrics": r.metrics() if status == SUCCEEDED else {},
            "logs": list(r.step_logs), "error": r.error, "traceback": trace, "retry_count": retry_count,
        }])

    def scorecard_rows(self) -> tuple[str, list[dict]]:
        o = self.result.validation
        return "scorecards", [] if o is None else [{
            "run_id": self.result.run_id, "pipeline": self.spec.name,
            "completeness": o.completeness, "consistency": o.consistency, "accuracy": o.accuracy,
            "overall_score": o.overall_score, "passed": o.passed, "checks": o.check_dicts(),
            "created_at": datetime.now(timezone.utc),
        }]

    def record(self, batch: DataFrame, outcome: ValidationOutcome) -> None:
        """Scorecard, dataset, schema version, statistics, anomalies, lineage of a successful run."""
        dataset, run_id, at = self.spec.dataset, self.result.run_id, datetime.now(timezone.utc)
        columns = columns_of(batch, self.hidden)
        # Small jobs over state tables that do not depend on each other.
        with ThreadPoolExecutor(max_workers=4) as pool:
            schema = pool.submit(self.schema_rows, dataset, run_id, at, columns)
            statistics = pool.submit(self.statistics_rows, dataset, run_id, at, outcome.extras)
            lineage = pool.submit(self.lineage_rows, dataset, at)
            known = pool.submit(self.state.has_dataset, dataset)
            indexes = [pool.submit(self.index_layer, layer) for layer in ("bronze", "silver")]
            for done in indexes:
                done.result()
        self.state.append_all([
            self.scorecard_rows(),
            ("column_sightings", [
                {"dataset": dataset, **c, "run_id": run_id, "seen_at": at} for c in columns
            ]),
            ("schema_versions", schema.result()),
            *statistics.result(),
            self.sketch_rows(dataset, run_id, at, outcome.extras),
            ("lineage", lineage.result()),
            ("datasets", [] if known.result() else [{"name": dataset, "created_at": at}]),
        ])

    def index_layer(self, layer: str) -> None:
        """Let incremental readers of this run's layers skip files; what a pipeline that reads whole tables
        writes is hardly read by time, so that has no index."""
        if not self.spec.incremental:
            return
        folder = self.bronze if layer == "bronze" else self.silver
        if not files.names(self.spark, folder):
            return
        column = self.spec.incremental.get("column")
        column = self.spec.renames.get(column, column) if layer == "silver" else column
        schema = self.spark.read.parquet(folder).schema
        columns = default_columns(schema)
        if column in schema.names and column not in columns:
            columns.append(column)
        index_run(self.spark, self.root, layer, self.spec.dataset, self.result.run_id, columns)

    def schema_rows(self, dataset: str, run_id: str, at: datetime, columns: list[dict]) -> list[dict]:
        row = {"dataset": dataset, "run_id": run_id, "columns": columns, "created_at": at}
        last = self.state.schema_version(dataset)
        if last is None:
            return [{
                **row, "version": 1, "added_columns": [], "removed_columns": [],
                "renamed_columns": [], "is_drift": False, "type_changes": [],
            }]
        drift = diff_schema([c.asDict() for c in last.columns], columns, self.spec.renames)
        if drift is None:
            return []
        self.log(f"schema drift: {drift}")
        return [{
            **row, "version": last.version + 1, "added_columns": drift["added"],
            "removed_columns": drift["removed"], "renamed_columns": drift["renamed"],
            "is_drift": True, "type_changes": drift["type_changes"],
        }]

    def lineage_rows(self, dataset: str, at: datetime) -> list[dict]:
        renames = [{"from": a, "to": b} for a, b in self.spec.renames.items()]
        chain = local_frame(
            self.spark,
            [{"pipeline": self.spec.name, "source": self.spec.source_name or self.spec.name,
              "dataset": dataset, "renames": renames}],
            "pipeline string, source string, dataset string, renames array<struct<from:string,to:string>>",
        )
        return [{**e.asDict(recursive=True), "recorded_at": at} for e in pipeline_edges(chain).collect()]

    def statistics_rows(self, dataset: str, run_id: str, at: datetime, extras: dict) -> list:
        columns = [n.split(":", 1)[1] for n in extras if n.startswith("count:")]
        rows = [
            {"dataset": dataset, "column": c,
             **{k: extras[f"{k}:{c}"] for k in ("count", "mean", "variance")}}
            for c in columns if extras[f"count:{c}"]
        ]
        if not rows:
            return []
        # One row per column from here on.
        moments = local_frame(
            self.spark, rows, "dataset string, column string, count bigint, mean double, variance double"
        )
        known = [row.asDict() for row in self.state.baseline(dataset, run_id).collect()]
        baseline = local_frame(self.spark, known, STATS_SCHEMA)
        judged = [r.asDict() for r in judge_and_merge(moments, baseline, ["dataset", "column"]).collect()]
        unusual = [r for r in judged if r["is_anomaly"]]
        if unusual:
            self.log(f"unusual means in {sorted(r['column'] for r in unusual)}")
        return [
            ("anomalies", [{**r, "run_id": run_id, "created_at": at} for r in unusual]),
            ("column_stats", [{**r, "run_id": run_id, "recorded_at": at} for r in judged]),
        ]

    def sketch_rows(self, dataset: str, run_id: str, at: datetime, extras: dict) -> tuple[str, list[dict]]:
        columns = [n.split(":", 1)[1] for n in extras if n.startswith("distinct:")]
        kept = lambda kind, c: bytes(extras[f"{kind}:{c}"]) if extras.get(f"{kind}:{c}") is not None else None
        return "column_sketches", [
            {"dataset": dataset, "run_id": run_id, "recorded_at": at, "column": c, "n": extras[f"n:{c}"],
             "quantiles": kept("quantiles", c), "distinct": kept("distinct", c)}
            for c in columns
        ]

    def record_watermark(self) -> None:
        if self.result.new_watermark is not None and self.result.new_watermark != self.watermark:
            self.state.append("watermarks", [{
                "pipeline": self.spec.name, "value": self.result.new_watermark, "kind": self.kind,
                "run_id": self.result.run_id, "recorded_at": datetime.now(timezone.utc),
            }])


def run_ingest(
    spark: SparkSession, root: str, spec: PipelineSpec, run_id: str, now: datetime | None = None,
    *, attempt: int = 1, attempts: int = 1,
) -> RunResult:
    """Run a pipeline once. Failures are raised again after they are on record.

    An outside scheduler that repeats failed runs calls this with the same ``run_id`` and a rising
    ``attempt``. Before the last attempt a failure leaves the run RETRYING; otherwise, and always
    when a rule blocked the batch, it ends FAILED with a dead letter.
    """
    now = now or datetime.now(timezone.utc)
    run = IngestRun(spark, root, spec, run_id, now)
    began = time.monotonic()
    run.event(RUNNING, retry_count=attempt - 1)
    try:
        targets.get_target(run.target)
        run.loaded = targets.open_dimension(spark, run.root, run.target).has_load_of(run_id)
        run.discard_layers(older_days_only=True)
        batch = run.stage_delta()
        outcome = run.check(batch)
        run.load(run.reshape(run.set_aside(batch, outcome)))
        run.record(batch, outcome)
        run.result.duration_seconds = time.monotonic() - began
        # The watermark moves only after everything else is in place.
        run.record_watermark()
        run.event(SUCCEEDED, datetime.now(timezone.utc), retry_count=attempt - 1)
        return run.result
    except Exception as exc:
        run.result.error = str(exc)
        trace = tb.format_exc()
        if not run.loaded:
            run.discard_layers()
            run.state.unpin(run_id)
        blocked = isinstance(exc, ValidationFailed)
        if attempt < attempts and not blocked:
            run.event(RETRYING, trace=trace, retry_count=attempt)
            raise
        run.state.append_all([
            *([run.scorecard_rows()] if blocked else []),
            ("dead_letters", [{
                "run_id": run_id, "error": run.result.error, "traceback": trace,
                "created_at": datetime.now(timezone.utc),
            }]),
        ])
        run.event(FAILED, datetime.now(timezone.utc), trace, retry_count=attempt - 1)
        raise


def try_ingest(
    spark: SparkSession, root: str, spec: PipelineSpec, run_id: str, now: datetime | None = None,
    *, attempts: int = 1,
) -> RunResult:
    """Up to ``attempts`` runs in a row; a typed failure comes back as a FAILED result."""
    for attempt in range(1, attempts + 1):
        try:
            return run_ingest(spark, root, spec, run_id, now, attempt=attempt, attempts=attempts)
        except ValidationFailed as exc:
            return RunResult(run_id, FAILED, validation=exc.outcome, error=str(exc))
        except EtlError as exc:
            failed = RunResult(run_id, FAILED, error=str(exc))
    return failed
