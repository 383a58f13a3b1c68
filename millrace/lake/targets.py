"""Gold targets as numbered snapshots over key buckets.

Current rows lie in buckets by the hash of their key: ``<target>/data/<load>/key_bucket=B``. A load reads
and writes anew only the buckets that its batch hits; the snapshot refers to the others where earlier loads
left them (:mod:`millrace.lake.commits`). ``<target>/closed/<load>`` has the versions a load closed. A load
becomes visible when its log entry appears, last, complete, and by a call that fails if the entry exists. So
readers see all of a load or nothing of it, what a dead load left is never read, of two loads that started
from the same snapshot the second fails loudly instead of undoing the first, and a run that is started again
finds its load there, counts included. History is appended, never rewritten; a load takes away the folders
that none of the newest ``keep`` snapshots refers to any more.

When a dimension has outgrown its buckets, the next load deals all rows to twice as many or more; so a load's work
is in proportion to its batch but for one whole rewrite each time the dimension doubles.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.errors import EtlError, LoadError, first_line
from millrace.functions.types import quoted
from millrace.lake import files
from millrace.lake.commits import CommitLog, Load, Snapshot, bucket_name
from millrace.operators.dimension import (
    CUSTOMERS, DimensionSpec, incoming, keys_fit_broadcast, merge_counts, merge_type2, untouched_rows,
    upsert_type1,
)
from millrace.session import local_frame

# Rows that a bucket is laid out for; it may come to twice as many. What a load's log entry lists grows with
# the number of buckets, which MOST_BUCKETS bounds: beyond it buckets get larger, of several files each.
BUCKET_ROWS = 500_000
MOST_BUCKETS = 1 << 16
# A bucket is a folder and a file in each load that hits it. Once there are MANY_BUCKETS, there are more only if
# each of them is worth a file, so that the number of files does not run away from small ``bucket_rows``.
MANY_BUCKETS = 256
FILE_ROWS = 50_000
# Snapshots whose rows stay readable.
KEEP = 10
BUCKET = "key_bucket"


@dataclass(frozen=True)
class Dimension:
    """A stored dimension."""

    spark: SparkSession
    folder: str
    spec: DimensionSpec
    bucket_rows: int = BUCKET_ROWS
    keep: int = KEEP

    @property
    def log(self) -> CommitLog:
        return CommitLog(self.spark, self.folder)

    def snapshot(self) -> Snapshot | None:
        return self.log.newest()

    def latest_seq(self) -> int:
        """Number of the newest complete load, 0 before the first one."""
        newest = self.snapshot()
        return newest.seq if newest else 0

    def load_of(self, run_id: str) -> Load | None:
        """The newest complete load of a run."""
        loads = self.log.loads(self.snapshot())
        return next((load for load in reversed(loads) if load.run == run_id), None)

    def has_load_of(self, run_id: str) -> bool:
        return self.load_of(run_id) is not None

    def rows_of(self, snapshot: Snapshot | None, buckets: set[int] | None = None) -> DataFrame:
        """Current rows of a snapshot, of all buckets or of some."""
        paths = snapshot.paths(buckets) if snapshot else []
        if not paths:
            return local_frame(self.spark, [], self.spec.schema)
        # Paths of one load and of single buckets stand side by side, so no columns are read from them.
        reader = self.spark.read.schema(self.spec.schema).option("recursiveFileLookup", "true")
        return reader.parquet(*[f"{self.folder}/data/{p}" for p in paths])

    def current(self, seq: int | None = None) -> DataFrame:
        return self.rows_of(self.snapshot() if seq is None else self.log.read(seq))

    def history(self) -> DataFrame:
        """Every version: the closed ones of all complete loads and the current ones."""
        newest = self.snapshot()
        folders = [f"{self.folder}/closed/{load.closed}" for load in self.log.loads(newest) if load.closed]
        current = self.rows_of(newest)
        if not folders:
            return current
        older = self.spark.read.schema(self.spec.schema).parquet(*folders)
        return older.select(*self.spec.columns).unionByName(current)

    # -- buckets --------------------------------------------------------------------------------

    def bucket_of(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def buckets_for(self, rows: int) -> int:
        """A power of two, so that more buckets split the ones there are."""
        wanted = max(1, -(-rows // self.bucket_rows))
        if wanted > MANY_BUCKETS:
            wanted = min(wanted, max(MANY_BUCKETS, -(-rows // FILE_ROWS)))
        return min(1 << (wanted - 1).bit_length(), MOST_BUCKETS)

    def layout(self, base: Snapshot | None, batch: DataFrame) -> int:
        """How many buckets the load after ``base`` deals rows to."""
        if base is None:
            return self.buckets_for(batch.count())
        wanted = self.buckets_for(base.rows)
        return wanted if wanted > 2 * base.buckets else base.buckets

    def hit(self, keys: DataFrame, buckets: int) -> set[int]:
        """The buckets of some keys; at most as many numbers as there are buckets."""
        key = F.col(quoted(self.spec.key))
        return {r.b for r in keys.select(self.bucket_of(key, buckets).alias("b")).distinct().collect()}

    def within(self, rows: DataFrame, wanted: set[int], buckets: int) -> DataFrame:
        """The rows of some buckets, whose numbers (at most MOST_BUCKETS) are broadcast."""
        listed = local_frame(self.spark, [{BUCKET: b} for b in sorted(wanted)], f"{BUCKET} int")
        key = F.col(quoted(self.spec.key))
        return rows.join(F.broadcast(listed), self.bucket_of(key, buckets) == listed[BUCKET], "left_semi")

    # -- writing --------------------------------------------------------------------------------

    def commit(
        self, base: Snapshot | None, rows: DataFrame, run_id: str, *, buckets: int,
        touched: set[int] | None = None, closed: DataFrame | None = None, counts: Callable[[], dict] = dict,
    ) -> dict:
        """Write the load that follows ``base`` and make it visible; returns its counts.

        ``rows`` are all rows of the ``touched`` buckets (None: of all); the others stay where they are.
        ``counts`` is asked for after the rows are written.
        """
        seq = base.seq + 1 if base else 1
        name = f"{seq:08d}-{run_id}"
        if closed is not None:
            closed.write.mode("overwrite").parquet(f"{self.folder}/closed/{name}")
        written = Observation()
        key = F.col(quoted(self.spec.key))
        placed = rows.withColumn(BUCKET, self.bucket_of(key, buckets)).observe(written, F.count(F.lit(1)).alias("n"))
        if buckets > 1:
            # Few files per bucket; a bucket that is larger than it was laid out for is still split.
            placed = placed.hint("rebalance", BUCKET)
        placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.folder}/data/{name}")
        held = sorted(
            int(b.split("=")[1]) for b in files.child_folders(self.spark, f"{self.folder}/data/{name}") if b.startswith(BUCKET)
        )
        folders, sizes, gone = {}, {}, 0
        if base is not None and touched is not None:
            for folder, had in base.folders.items():
                left = [b for b in had if b not in touched]
                if left:
                    folders[folder], sizes[folder] = left, base.written[folder]
            gone = self.rows_of(base, touched).count()
        if held:
            folders[name] = held
            sizes[name] = len(held)
        kept = base.rows - gone if base is not None and touched is not None else 0
        found = counts()
        load = Load(seq, run_id, found, name if closed is not None else None)
        made = self.log.append(
            base, load, buckets=buckets, rows=kept + written.get["n"], folders=folders, written=sizes
        )
        if made is None:
            raise LoadError(f"another load became number {seq} of {self.folder} meanwhile; start run {run_id!r} again")
        self.vacuum(self.keep, made)
        return found

    def write(self, base: int, current: DataFrame, closed: DataFrame | None = None, run_id: str = "none") -> None:
        """Write ``current`` as all rows of the load that follows snapshot ``base``."""
        before = self.log.read(base) if base else None
        self.commit(before, current, run_id, buckets=self.layout(before, current), closed=closed)

    def vacuum(self, keep: int = KEEP, newest: Snapshot | None = None) -> list[str]:
        """Remove the folders that complete loads wrote and none of the newest ``keep`` snapshots refers to.

        History stays. What is looked at are the snapshots that go out of reach, and each only once: their own
        log entries stay, but ``cleared`` says up to which load their rows are gone.
        """
        newest = newest or self.snapshot()
        if newest is None:
            return []
        reach = [s for s in map(self.log.read, range(max(1, newest.seq - keep + 1), newest.seq + 1)) if s]
        referred = set().union(*[s.references() for s in reach])
        cleared = f"{self.folder}/cleared"
        since = max((int(n) for n in files.names(self.spark, cleared)), default=0)
        last, gone = newest.seq - keep, []
        for seq in range(since + 1, last + 1):
            old = self.log.read(seq)
            for folder, bucket in sorted(old.references() - referred) if old else []:
                gone.append(f"{self.folder}/data/{folder}/{bucket_name(bucket)}")
                files.remove(self.spark, gone[-1])
        if last > since:
            files.publish(self.spark, f"{cleared}/{last}", "")
            for n in files.names(self.spark, cleared):
                if int(n) < last:
                    files.remove(self.spark, f"{cleared}/{n}")
        return gone


def load_type1(
    dim: Dimension, batch: DataFrame, order_by: list[str], now: datetime, run_id: str = "none"
) -> dict:
    """Overwrite in place; loading the same batch again changes nothing."""
    base = dim.snapshot()
    buckets = dim.layout(base, batch)
    touched = _touched(dim, base, batch, buckets)
    small = keys_fit_broadcast(batch, dim.spec)
    created = Observation()
    merged = upsert_type1(
        dim.rows_of(base, touched), batch, dim.spec, order_by, now, broadcast_keys=small, created=created
    )

    # Every row that did not create its key updated it, as in a row-by-row load.
    def counts() -> dict:
        return {"created": created.get["keys"], "updated": batch.count() - created.get["keys"]}

    return dim.commit(base, merged, run_id, buckets=buckets, touched=touched, counts=counts)


def _touched(dim: Dimension, base: Snapshot | None, batch: DataFrame, buckets: int) -> set[int] | None:
    """The buckets that hold the batch's keys; None if all rows have to be dealt anew."""
    if base is None or base.buckets != buckets:
        return None
    return dim.hit(incoming(batch, dim.spec), buckets)


def load_type2(
    dim: Dimension, batch: DataFrame, order_by: list[str], now: datetime, run_id: str = "none",
    collapse: bool = False,
) -> dict:
    """Close changed versions, open new ones; buckets without any change are not written."""
    base = dim.snapshot()
    buckets = dim.layout(base, batch)
    touched = _touched(dim, base, batch, buckets)
    # The versions of the batch's keys are needed several times, so they are written down once.
    staged = f"{dim.folder}/staged/run_id={run_id}"
    small = keys_fit_broadcast(batch, dim.spec)
    merge_type2(
        dim.rows_of(base, touched), batch, dim.spec, order_by, now, collapse=collapse, broadcast_keys=small
    ).write.mode("overwrite").parquet(staged)
    versions = dim.spark.read.parquet(staged)
    counts = merge_counts(versions).first().asDict()
    if touched is not None:
        # Buckets in which nothing changed stay where they are.
        touched = dim.hit(versions.filter("NOT is_seed"), buckets)
        versions = dim.within(versions, touched, buckets)
    current = dim.rows_of(base, touched)
    fresh = versions.filter("is_current").select(*dim.spec.columns)
    closed = versions.filter("NOT is_current").select(*dim.spec.columns)
    kept = untouched_rows(current, batch, dim.spec, broadcast_keys=small)
    dim.commit(
        base, kept.unionByName(fresh), run_id, buckets=buckets, touched=touched, closed=closed, counts=lambda: counts
    )
    files.remove(dim.spark, staged)
    return counts


Loader = Callable[[Dimension, DataFrame, list, datetime, str], dict]


@dataclass(frozen=True)
class Target:
    """A named way to load: the loader and the table it feeds."""

    table: str
    loader: Loader
    spec: DimensionSpec = CUSTOMERS


# Two strategies over one table, which therefore share one gold snapshot.
_TARGETS: dict[str, Target] = {
    "customers": Target("customers", load_type1),
    "customers_scd2": Target("customers", load_type2),
}


def register_target(name: str, target: Target) -> None:
    _TARGETS[name] = target


def get_target(name: str) -> Target:
    if name not in _TARGETS:
        raise LoadError(f"no target called {name!r}; known: {sorted(_TARGETS)}")
    return _TARGETS[name]


def open_dimension(spark: SparkSession, root: str, name: str, **options) -> Dimension:
    """The stored dimension of a target; ``options`` set its layout (``bucket_rows``, ``keep``)."""
    target = get_target(name)
    return replace(Dimension(spark, f"{root}/targets/{target.table}", target.spec), **options)


def load(
    spark: SparkSession, root: str, name: str, batch: DataFrame, order_by: list[str], now: datetime,
    run_id: str, **options,
) -> dict:
    """Load a run's batch into a target; whatever goes wrong surfaces as LoadError.

    A run whose load is complete already (it failed later on and was started again) loads nothing and gets
    the counts of that load.
    """
    target = get_target(name)
    try:
        dim = open_dimension(spark, root, name, **options)
        done = dim.load_of(run_id)
        return dict(done.counts) if done else target.loader(dim, batch, order_by, now, run_id)
    except EtlError:
        raise
    except PySparkException as exc:
        raise LoadError(f"target {name!r}: {first_line(exc)}") from exc
