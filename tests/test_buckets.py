"""Dimensions in key buckets: what a load writes, what stays, and what a crash may leave."""

from datetime import datetime
from pathlib import Path

import pytest

from millrace.errors import LoadError
from millrace.lake import commits, files, targets
from millrace.lake.state import State
from millrace.plans.ingest import IngestRun, PipelineSpec, run_ingest

DAY = datetime(2024, 5, 1)
LATER = datetime(2024, 6, 1)


def people(spark, ids, mail="m", extra=0):
    return spark.createDataFrame([(i, f"{mail}{i}", extra) for i in ids], "customer_id bigint, email string, seen int")


def open_small(spark, lake, **options):
    return targets.open_dimension(spark, lake, "customers", **{"bucket_rows": 50, **options})


def load(spark, lake, name, batch, run, now=DAY, **options):
    return targets.load(spark, lake, name, batch, ["seen"], now, run, **{"bucket_rows": 50, **options})


def data_files(dim):
    return {str(f): f.stat().st_mtime_ns for f in Path(f"{dim.folder}/data").rglob("*.parquet")}


@pytest.mark.parametrize("name", ["customers", "customers_scd2"])
def test_a_batch_of_one_key_writes_one_bucket(spark, lake, name):
    load(spark, lake, name, people(spark, range(1000)), "first")
    dim = open_small(spark, lake)
    before = data_files(dim)
    assert dim.snapshot().buckets == 32 and dim.snapshot().rows == 1000
    assert load(spark, lake, name, people(spark, [7], "new"), "second", LATER) == {"created": 0, "updated": 1}
    after = data_files(dim)
    written = {f for f in after if f not in before}
    assert {Path(f).parent.name for f in written} == {f"key_bucket={b}" for b in dim.hit(dim.current().filter("external_id = '7'"), 32)}
    assert {f: t for f, t in after.items() if f in before} == before
    rows = {r.external_id: r.email for r in dim.current().collect()}
    assert len(rows) == 1000 and rows["7"] == "new7" and rows["8"] == "m8"
    assert dim.history().count() == (1001 if name == "customers_scd2" else 1000)
    assert dim.snapshot().rows == 1000
    assert dim.current(1).filter("external_id = '7'").first().email == "m7"


def test_what_changes_nothing_writes_nothing(spark, lake):
    load(spark, lake, "customers_scd2", people(spark, range(300)), "first")
    dim = open_small(spark, lake)
    before = data_files(dim)
    assert load(spark, lake, "customers_scd2", people(spark, range(100), extra=9), "same", LATER) == {"created": 0, "updated": 0}
    assert data_files(dim) == before and dim.latest_seq() == 2
    assert sorted(dim.current().collect()) == sorted(dim.current(1).collect())


def test_an_outgrown_dimension_gets_more_buckets(spark, lake):
    load(spark, lake, "customers", people(spark, range(10)), "r0")
    dim = open_small(spark, lake)
    assert dim.snapshot().buckets == 1
    load(spark, lake, "customers", people(spark, range(5, 500)), "r1", LATER)
    load(spark, lake, "customers", people(spark, [1]), "r2", LATER)
    assert dim.snapshot().buckets == 16 and dim.snapshot().rows == 500
    assert dim.current().groupBy("external_id").count().filter("count > 1").isEmpty()
    assert dim.current().filter("valid_from < '2024-05-15'").count() == 10


def test_small_buckets_are_many_but_not_a_file_for_every_few_rows(spark, lake):
    load(spark, lake, "customers", people(spark, range(1500)), "first", bucket_rows=1)
    dim = open_small(spark, lake, bucket_rows=1)
    assert dim.snapshot().buckets == 256 and len({Path(f).parent for f in data_files(dim)}) <= 256
    before = data_files(dim)
    assert load(spark, lake, "customers", people(spark, [7, 2000], "new"), "second", LATER, bucket_rows=1) == {"created": 1, "updated": 1}
    # it has not outgrown its buckets, so only those of the two keys are written
    assert dim.snapshot().buckets == 256 and 1 <= len({Path(f).parent for f in data_files(dim) if f not in before}) <= 2
    assert dim.current().count() == 1501 and dim.current().filter("email = 'new7'").count() == 1


def test_buckets_grow_with_the_rows(spark, lake):
    small, usual = open_small(spark, lake, bucket_rows=100), open_small(spark, lake, bucket_rows=500_000)
    assert [small.buckets_for(n) for n in (0, 1, 101, 25_600, 5_400_000, 10**8)] == [1, 1, 2, 256, 256, 2048]
    assert [usual.buckets_for(n) for n in (1, 10**6, 10**9, 10**12)] == [1, 2, 2048, targets.MOST_BUCKETS]


def test_loads_in_buckets_equal_loads_in_one(spark, tmp_path):
    found = {}
    for rows in (3, 10_000):
        root = str(tmp_path / str(rows))
        for i in range(6):
            ids = [(j * 7 + i) % 60 for j in range(10 * (i + 1))]
            rows_of = [(j, f"v{i % 3}-{j}-{place % 2}", place) for place, j in enumerate(ids)]
            batch = spark.createDataFrame(rows_of, "customer_id bigint, email string, seen int")
            load(spark, root, ("customers_scd2", "customers")[i == 3], batch, f"r{i}", datetime(2024, 5, 1 + i), bucket_rows=rows, keep=2)
        dim = open_small(spark, root)
        found[rows] = (sorted(map(str, dim.history().collect())), sorted(map(str, dim.current().collect())), [x.counts for x in dim.log.loads(dim.snapshot())])
    assert found[3] == found[10_000]


def test_vacuum_removes_only_what_no_kept_snapshot_refers_to(spark, lake):
    load(spark, lake, "customers", people(spark, range(400)), "r0")
    for i in range(1, 5):
        load(spark, lake, "customers", people(spark, [i], "new"), f"r{i}", keep=2)
    dim = open_small(spark, lake)
    held = {str(Path(f).parent.relative_to(f"{dim.folder}/data")) for f in data_files(dim)}
    referred = {f"{f}/key_bucket={b}" for seq in (4, 5) for f, b in dim.log.read(seq).references()}
    assert held == referred
    assert dim.current().count() == dim.current(4).count() == 400
    assert dim.vacuum(2) == [] and len(files.names(spark, f"{dim.folder}/cleared")) == 1


def test_the_log_of_many_loads_is_read_in_two_files(spark, lake, monkeypatch):
    monkeypatch.setattr(commits, "WHOLE_LOG", 4)
    dim = targets.open_dimension(spark, lake, "customers", keep=50)
    rows = dim.current()
    for i in range(1, 12):
        dim.write(i - 1, rows, rows if i % 2 else None, run_id=f"r{i}")
    opened = []
    text = files.text
    monkeypatch.setattr(files, "text", lambda s, p: opened.append(p) or text(s, p))
    loads = dim.log.loads(dim.snapshot())
    assert [x.run for x in loads] == [f"r{i}" for i in range(1, 12)] and len(opened) == 2
    assert [x.closed is not None for x in loads] == [i % 2 == 1 for i in range(1, 12)]
    assert dim.has_load_of("r3") and not dim.has_load_of("r12") and dim.history().count() == 0


@pytest.mark.parametrize("left", ["", "{", '{"seq": 2}', "a run's name"])
def test_an_entry_without_content_is_no_load(spark, lake, left):
    load(spark, lake, "customers", people(spark, [1]), "r1")
    dim = open_small(spark, lake)
    Path(f"{dim.folder}/log/2").write_text(left)
    assert dim.latest_seq() == 1 and dim.current().count() == 1
    load(spark, lake, "customers", people(spark, [2]), "r2")
    assert dim.latest_seq() == 2 and dim.current().count() == 2 and dim.has_load_of("r2")


def test_a_crash_while_the_entry_is_written_leaves_the_last_snapshot(spark, lake, monkeypatch):
    load(spark, lake, "customers", people(spark, [1]), "r1")
    dim = open_small(spark, lake)

    class Killed(BaseException):
        pass

    with monkeypatch.context() as patch:
        def write_half(s, path, content):
            Path(path).write_text(content[: len(content) // 2])
            raise Killed

        patch.setattr(files, "_write", write_half)
        with pytest.raises(Killed):
            load(spark, lake, "customers", people(spark, [2]), "r2")
    assert dim.latest_seq() == 1 and [r.external_id for r in dim.current().collect()] == ["1"]
    assert load(spark, lake, "customers", people(spark, [2]), "r2") == {"created": 1, "updated": 0}
    assert dim.current().count() == 2


def test_publish_never_replaces(spark, tmp_path):
    path = f"{tmp_path}/log/1"
    assert files.publish(spark, path, "a") and not files.publish(spark, path, "b")
    assert files.text(spark, path) == "a" and files.names(spark, f"{tmp_path}/log") == ["1"]


def test_a_slower_load_fails_and_its_restart_goes_through(spark, lake):
    load(spark, lake, "customers", people(spark, range(200)), "r1")
    dim = open_small(spark, lake)
    base = dim.snapshot()
    load(spark, lake, "customers", people(spark, [3], "fast"), "fast")
    with pytest.raises(LoadError, match="another load"):
        dim.commit(base, dim.rows_of(base).limit(1), "slow", buckets=base.buckets)
    assert load(spark, lake, "customers", people(spark, [3], "slow"), "slow") == {"created": 0, "updated": 1}
    assert dim.current().filter("external_id = '3'").first().email == "slow3" and dim.current().count() == 200


def test_a_restarted_run_reports_its_load(spark, tmp_path, lake, monkeypatch):
    path = tmp_path / "in.csv"
    path.write_text("customer_id,email\n1,a\n2,b\n2,c\n")
    spec = PipelineSpec(name="p", source={"type": "file", "path": str(path)}, target="customers")

    class Killed(BaseException):
        pass

    with monkeypatch.context() as patch:
        def die(self, *a):
            raise Killed

        patch.setattr(IngestRun, "record", die)
        with pytest.raises(Killed):
            run_ingest(spark, lake, spec, "r1", DAY)
    result = run_ingest(spark, lake, spec, "r1", LATER)
    assert result.load_result == {"created": 2, "updated": 1} and result.rows_loaded == 3
    run = State(spark, lake).runs().first()
    assert (run.metrics["created"], run.metrics["updated"]) == (2.0, 1.0)


@pytest.mark.parametrize("at", [1, 2])
def test_a_compaction_that_dies_loses_no_state(spark, lake, monkeypatch, at):
    state = State(spark, lake)
    for i in range(3):
        state.append("watermarks", [{"pipeline": "p", "value": str(i), "kind": "number", "run_id": f"r{i}", "recorded_at": datetime(2024, 1, 1 + i)}])
    calls, rename = [], files.rename
    with monkeypatch.context() as patch:
        def die(*args):
            calls.append(args)
            if len(calls) == at:
                raise OSError("gone")
            return rename(*args)

        patch.setattr(files, "rename", die)
        with pytest.raises(OSError, match="gone"):
            state.compact("watermarks")
    assert state.watermark("p").value == "2"
    state.append("watermarks", [{"pipeline": "p", "value": "9", "kind": "number", "run_id": "r9", "recorded_at": LATER}])
    state.compact("watermarks")
    assert state.read("watermarks").count() == 4 and state.watermark("p").value == "9"
    assert len(list(Path(f"{lake}/state/watermarks").rglob("*.parquet"))) == 1
