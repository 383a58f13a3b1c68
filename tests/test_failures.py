"""What a failure leaves behind: nothing may be lost, nothing may appear twice, nothing may go unseen."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.errors import ExtractError, LoadError
from millrace.lake import targets
from millrace.lake.state import State
from millrace.operators import rules as R
from millrace.operators.dimension import CUSTOMERS, merge_type2, upsert_type1
from millrace.operators.duplicates import repeated_rows
from millrace.operators.lineage import edges_of_dataset, lineage_edges
from millrace.plans import ingest
from millrace.plans.ingest import PipelineSpec, run_ingest
from millrace.sources import POSITION, extract

DAY = datetime(2024, 5, 1)


def people(path, rows):
    path.write_text("customer_id,email,seen\n" + "".join(f"{i},p{i}@x.org,{t}\n" for i, t in rows))


def spec_of(path, target="customers_scd2"):
    return PipelineSpec(
        name="people", source={"type": "file", "path": str(path)}, target=target,
        incremental={"column": "seen", "initial_value": 0, "kind": "number"}, order_by=["seen"],
    )


def contents(spark, lake):
    dim = targets.open_dimension(spark, lake, "customers_scd2")
    layers = {
        layer: sorted(r.customer_id for r in spark.read.parquet(f"{lake}/layers/{layer}/customers_scd2").collect())
        for layer in ("bronze", "silver")
    }
    gold = sorted((r.external_id, r.is_current) for r in dim.history().collect())
    return {**layers, "gold": gold, "watermark": State(spark, lake).watermark("people").value}


class Killed(BaseException):
    """Ends the process, as far as the run can tell: no handler of its own sees it."""


@pytest.mark.parametrize("step", ["check", "reshape", "load", "record", "record_watermark", "after_watermark"])
def test_restart_after_each_step_equals_an_uninterrupted_run(spark, tmp_path, monkeypatch, step):
    lake, whole, csv = str(tmp_path / "killed"), str(tmp_path / "whole"), tmp_path / "people.csv"
    people(csv, [(1, 1), (2, 2)])
    run_ingest(spark, whole, spec_of(csv), "r1", DAY)
    with monkeypatch.context() as patch:
        name = "event" if step == "after_watermark" else step
        original = getattr(ingest.IngestRun, name)

        def die(self, *args, **kwargs):
            if step != "after_watermark":
                if step in ("load", "record"):
                    original(self, *args, **kwargs)
                raise Killed
            if args[0] == "SUCCEEDED":
                raise Killed
            return original(self, *args, **kwargs)

        patch.setattr(ingest.IngestRun, name, die)
        with pytest.raises(Killed):
            run_ingest(spark, lake, spec_of(csv), "r1", DAY)
    people(csv, [(1, 1), (2, 2), (77, 7)])  # a row arrives in between
    run_ingest(spark, lake, spec_of(csv), "r1", datetime(2024, 5, 2))
    assert contents(spark, lake) == contents(spark, whole)
    for root in (lake, whole):
        run_ingest(spark, root, spec_of(csv), "r2", datetime(2024, 5, 3))
    assert contents(spark, lake) == contents(spark, whole)
    assert ("77", True) in contents(spark, lake)["gold"]


def batch(spark, rows):
    return spark.createDataFrame(rows, "customer_id bigint, email string, signup_date date, seen int")


def test_closed_versions_of_a_dead_load_stay_unseen(spark, lake):
    dim = targets.open_dimension(spark, lake, "customers")
    targets.load(spark, lake, "customers_scd2", batch(spark, [(1, "a@x", None, 1)]), ["seen"], DAY, "r1")
    current = dim.current()
    current.withColumn("is_current", F.lit(False)).write.parquet(f"{dim.folder}/closed/00000002-dead")
    targets.load(spark, lake, "customers", batch(spark, [(2, "b@x", None, 1)]), ["seen"], DAY, "r2")
    assert sorted((r.external_id, r.is_current) for r in dim.history().collect()) == [("1", True), ("2", True)]


def test_of_two_writers_one_fails_loudly(spark, lake):
    dim = targets.open_dimension(spark, lake, "customers")
    one = upsert_type1(dim.current(), batch(spark, [(1, "a@x", None, 1)]), CUSTOMERS, ["seen"], DAY)
    two = upsert_type1(dim.current(), batch(spark, [(2, "b@x", None, 1)]), CUSTOMERS, ["seen"], DAY)
    dim.write(0, one, run_id="one")
    with pytest.raises(LoadError, match="another load"):
        dim.write(0, two, run_id="two")
    assert [r.external_id for r in dim.current().collect()] == ["1"]
    assert dim.has_load_of("one") and not dim.has_load_of("two")


def test_vacuum_keeps_history_and_the_newest_snapshots(spark, lake):
    dim = targets.open_dimension(spark, lake, "customers")
    for i, mail in enumerate("abcd"):
        targets.load(spark, lake, "customers_scd2", batch(spark, [(1, mail, None, i)]), ["seen"], datetime(2024, 5, 1 + i), f"r{i}")
    before = dim.history().count()
    assert len(dim.vacuum(keep=1)) == 3
    assert dim.history().count() == before == 4 and dim.has_load_of("r0")


def test_order_by_an_attribute(spark):
    rows = batch(spark, [(1, "b@x", None, 2), (1, "a@x", None, 3), (1, "c@x", None, 1)])
    dim = rows.limit(0).selectExpr("string(customer_id) external_id").select("external_id", *[F.lit(None).cast(CUSTOMERS.type_of(c)).alias(c) for c in CUSTOMERS.columns[1:]])
    upserted = upsert_type1(dim, rows, CUSTOMERS, ["email"], DAY).collect()
    assert [r.email for r in upserted] == ["c@x"]
    merged = merge_type2(dim, rows, CUSTOMERS, ["email", "signup_date"], DAY).filter("is_current").collect()
    assert [r.email for r in merged] == ["c@x"]


def test_parquet_source_without_order(spark, tmp_path, lake):
    path = str(tmp_path / "in")
    batch(spark, [(1, "a@x", None, 1), (2, "b@x", None, 2)]).write.parquet(path)
    for target in ("customers", "customers_scd2"):
        spec = PipelineSpec(name=f"p-{target}", source={"type": "parquet", "path": path}, target=target)
        result = run_ingest(spark, lake, spec, f"r-{target}", DAY)
        assert (result.status, result.rows_extracted, result.rows_loaded) == ("SUCCEEDED", 2, 2)


def test_rules_that_fail_on_rows_fail_as_one_check(spark):
    df = spark.createDataFrame([(1, 0, "4"), (9, 3, "n.a."), (2, 1, "7")], "a int, q int, age string")
    specs = [
        {"type": "business_rule", "name": "ratio", "expression": "a / q > 1"},
        {"type": "business_rule", "name": "grown", "expression": "age > 3"},
        {"type": "not_null", "columns": ["a"]},
    ]
    found = {r.rule_type: (r.passed, r.violation_count) for r in R.rule_results(df, specs).collect()}
    assert found == {"ratio": (False, 1), "grown": (False, 1), "not_null": (True, 0)}
    assert [r.is_quarantined for r in R.quarantine_split(df, specs).orderBy("q").collect()] == [True, False, True]
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_query_errors_keep_their_message(spark):
    df = spark.createDataFrame([(1,)], "a int")
    R.rule_results(df, [{"type": "business_rule", "name": "x", "expression": "no_such = 1"}]).collect()
    with pytest.raises(Exception, match="no_such_column"):
        df.select("no_such_column")


@pytest.mark.parametrize("line", ["3,4,9", "3,4,,9", "3,4,NA", "3,4,", '3,"4,5",6'])
@pytest.mark.parametrize("schema", [None, "a int, b int"])
def test_surplus_fields_are_an_error(spark, tmp_path, line, schema):
    path = tmp_path / "t.csv"
    path.write_text(f"a,b\n1,2\n{line}\n")
    with pytest.raises(Exception, match="more fields"):
        extract(spark, "file", {"path": str(path), "schema": schema, "multi_line": None if schema is None else False}).collect()


def test_short_rows_and_quoted_commas_are_fine(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b\n1,"x,y"\n2\n')
    rows = extract(spark, "file", {"path": str(path)}).orderBy("a").drop(POSITION).collect()
    assert [tuple(r) for r in rows] == [(1, "x,y"), (2, None)]


def test_a_row_like_the_header_is_data(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,2\na,b\n3,4\n")
    rows = extract(spark, "file", {"path": str(path)}).drop(POSITION).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "2"), ("3", "4"), ("a", "b")]


def test_microseconds_in_nested_values_differ(spark):
    df = spark.sql("select array(timestamp '2024-01-01 00:00:00.000001') t union all select array(timestamp '2024-01-01 00:00:00.000002')")
    assert repeated_rows(df).first().n == 0


def test_lineage_counts_the_latest_mapping_once(spark):
    kind = "pipeline string, source string, dataset string, renames array<struct<from:string,to:string>>, recorded_at timestamp"
    rows = [("p", "s", "d", [("z", "b")], datetime(2024, 1, 1)), ("p", "s", "d", [("a", "b")], datetime(2024, 1, 2))]
    edges = lineage_edges(spark.createDataFrame(rows, kind))
    assert edges.count() == 3
    mapping = edges.filter("from_layer = 'BRONZE'").first().column_mapping
    assert [(m["from"], m["to"]) for m in mapping] == [("a", "b")]


def test_state_serves_what_runs_wrote(spark, tmp_path, lake):
    csv = tmp_path / "people.csv"
    for i in range(3):
        people(csv, [(1, 1), (2, 2 + i)])
        run_ingest(spark, lake, spec_of(csv), f"r{i}", datetime(2024, 5, 1 + i))
    with pytest.raises(ExtractError):
        run_ingest(spark, lake, spec_of(tmp_path / "gone.csv"), "r3", datetime(2024, 5, 5))
    state = State(spark, lake)
    row = state.dashboard().first()
    assert (row.total_runs, row.succeeded, row.failed, row.success_rate_percent) == (4, 3, 1, 75.0)
    assert row.avg_duration_seconds > 0
    assert [(r.run_id, r.has_dead_letter) for r in state.failed_runs().collect()] == [("r3", True)]
    assert [r.score_delta is None for r in state.score_trend().orderBy("created_at").collect()] == [True, False, False]
    assert len(state.lineage_graph("customers_scd2")["edges"]) == 3
    assert edges_of_dataset(state.read("lineage"), "customers_scd2").count() == 3
    assert [r.version for r in state.drift_history("customers_scd2").collect()] == [1]
    assert state.unusual_columns("customers_scd2").count() == 0
    for table in ("run_events", "datasets"):
        before = state.read(table).count()
        state.compact(table)
        assert state.read(table).count() == before
