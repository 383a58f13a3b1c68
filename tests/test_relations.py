"""Filters along relationships."""

from datetime import datetime

import pytest

from millrace.lake.state import State
from millrace.operators.relations import Model, UnknownPath
from millrace.plans.ingest import PipelineSpec, try_ingest


@pytest.fixture(scope="module")
def model(spark):
    people = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", None), (4, None, 99)], "id int, name string, town int")
    towns = spark.createDataFrame([(10, "x", "n"), (20, "y", "s"), (20, "y", "n"), (None, "z", "s")], "id int, name string, `in` string")
    pets = spark.createDataFrame([(1, 1, "cat"), (2, 1, "dog"), (3, 2, "cat"), (4, None, "cat"), (5, 1, "cat")], "id int, owner int, kind string")
    return (
        Model({"people": people, "towns": lambda: towns, "pets": pets})
        .refers("people", "town", "town", "towns", "id")
        .refers("pets", "owner", "owner", "people", "id", reverse="pets")
    )


@pytest.mark.parametrize(
    ("table", "conditions", "wanted"),
    [
        ("people", {}, [1, 2, 3, 4]), ("people", {"name": "a"}, [1]), ("people", {"name": None}, [4]), ("people", {"town__name": "y"}, [2]),
        ("people", {"town__in__in": ["s", "n"]}, [1, 2]), ("people", {"town__in": [10, 99]}, [1, 4]), ("people", {"town__isnull": True}, [3]),
        ("pets", {"owner__town__name": "x"}, [1, 2, 5]), ("pets", {"owner__town__name": "x", "kind": "cat"}, [1, 5]),
        ("pets", {"owner__name": "a", "owner__town": 20}, []), ("pets", {"owner__name__in": ["a", "b"], "owner__town__gte": 20}, [3]),
        ("people", {"pets__kind": "cat"}, [1, 2]), ("people", {"pets__kind": "dog", "pets__id": 1}, []), ("people", {"pets__id__lt": 3}, [1]),
        ("pets", {"owner__pets__kind": "dog"}, [1, 2, 5]), ("pets", {"owner__town__name": "nowhere"}, []),
    ],
)
def test_conditions(model, table, conditions, wanted):
    assert sorted(r.id for r in model.filtered(table, **conditions).collect()) == wanted


@pytest.mark.parametrize(
    ("table", "path", "told"),
    [
        ("people", "nme", "nme"), ("people", "town__size", "size"), ("people", "city__name", "city"), ("people", "name__town", "name"),
        ("pets", "owner__town__mayor__name", "mayor"), ("nothing", "x", "nothing"), ("people", "name__like", "name"),
    ],
)
def test_unknown_paths_are_errors(model, table, path, told):
    with pytest.raises(UnknownPath, match=told):
        model.filtered(table, **{path: 1})


def test_related_columns(model):
    rows = model.with_related(model.table("pets"), "pets", owner_name="owner__name", place="owner__town__name")
    found = sorted(((r.id, r.owner_name, r.place) for r in rows.collect()))
    assert found == [(1, "a", "x"), (2, "a", "x"), (3, "b", "y"), (4, None, None), (5, "a", "x")]
    with pytest.raises(UnknownPath, match="many rows"):
        model.with_related(model.table("people"), "people", kind="pets__kind")
    with pytest.raises(UnknownPath, match="another table"):
        model.with_related(model.table("people"), "people", n="name")


def test_each_table_is_filtered_and_cut_before_it_is_met(spark):
    folder = "/root/testdata/sf0.001"
    model = Model({n: (lambda n=n: spark.read.parquet(f"{folder}/{n}.parquet")) for n in ("orders", "customer", "nation")})
    model.refers("orders", "customer", "o_custkey", "customer", "c_custkey").refers("customer", "nation", "c_nationkey", "nation", "n_nationkey")
    found = model.filtered("orders", customer__nation__n_name="CHINA", customer__c_mktsegment="BUILDING").select("o_orderkey")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    schema = {line.split("ReadSchema: ")[1] for line in scans}
    assert {s.replace("bigint", "int") for s in schema} == {
        "struct<o_orderkey:int,o_custkey:int>", "struct<c_custkey:int,c_nationkey:int,c_mktsegment:string>", "struct<n_nationkey:int,n_name:string>",
    }
    assert any("EqualTo(c_mktsegment,BUILDING)" in line for line in scans) and any("EqualTo(n_name,CHINA)" in line for line in scans)
    assert plan.count("LeftSemi") == 2


def test_state_is_served_along_relations(spark, tmp_path, lake):
    def run(pipeline, target, run_id, rows, day):
        path = str(tmp_path / run_id)
        spark.createDataFrame(rows, "customer_id int, email string, age int").write.parquet(path)
        spec = PipelineSpec(
            pipeline, {"type": "parquet", "path": path}, target=target,
            validation={"rules": [{"type": "not_null", "columns": ["email"]}]},
        )
        return try_ingest(spark, lake, spec, run_id, datetime(2024, 1, day))

    assert run("one", "customers", "r1", [(1, "a", 5)], 1).status == "SUCCEEDED"
    assert run("two", "customers_scd2", "r2", [(1, "a", 5)], 2).status == "SUCCEEDED"
    assert run("two", "customers_scd2", "r3", [(1, None, 5)], 3).status == "FAILED"
    state = State(spark, lake)
    assert [r.run_id for r in state.served("scorecards", run__pipeline="one").collect()] == ["r1"]
    assert [r.run_id for r in state.served("scorecards", run__status="FAILED", passed=False).collect()] == ["r3"]
    assert [r.run_id for r in state.served("dead_letters", run__dataset__name="customers_scd2").collect()] == ["r3"]
    assert [r.version for r in state.served("schema_versions", dataset__name="customers", is_drift=False).collect()] == [1]
    assert [r.run_id for r in state.served("runs", scorecard__passed=False).collect()] == ["r3"]
    stats = state.served("column_stats", dataset__name="customers_scd2", column="age")
    assert [r["count"] for r in stats.collect()] == [1]
    with pytest.raises(UnknownPath, match="dataset__size"):
        state.served("anomalies", dataset__size=1)
    rows = state.model().with_related(state.read("scorecards"), "scorecards", status="run__status", since="run__dataset__created_at")
    assert {r.run_id: r.status for r in rows.collect()} == {"r1": "SUCCEEDED", "r2": "SUCCEEDED", "r3": "FAILED"}
