"""Sketches against exact quantiles and counts."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.lake.state import State
from millrace.operators import rules as R
from millrace.operators import sketches
from millrace.plans.ingest import PipelineSpec, run_ingest


def test_merged_quantiles_are_within_the_rank_error(spark):
    n = 60_000
    rows = spark.range(n).selectExpr("id", "id * 7919 % 60000 AS v", "id % 12 AS run", "string(id % 5) AS g")
    stored = sketches.sketch_columns(rows, ["v"], ["g", "run"])
    assert stored.count() == 60
    for runs in ([0], list(range(12)), [3, 4, 5, 6]):
        part, kept = rows.filter(F.col("run").isin(runs)), stored.filter(F.col("run").isin(runs))
        for row in sketches.quantiles(kept, ["g"], [0.01, 0.25, 0.5, 0.99]).collect():
            values = sorted(r.v for r in part.filter(F.col("g") == row.g).collect())
            assert row.n == len(values)
            for rank in (0.01, 0.25, 0.5, 0.99):
                found = row[f"p{rank * 100:g}"]
                at = sum(v <= found for v in values) / len(values)
                assert abs(at - rank) <= sketches.RANK_ERROR + 1 / len(values)


def test_no_values(spark):
    rows = spark.createDataFrame([("a", None, None), ("a", float("nan"), ""), ("b", 1.0, "x")], "g string, v double, t string")
    found = {(r.g, r.column): r for r in sketches.sketch_columns(rows, ["v", "t"], ["g"]).collect()}
    assert found["a", "v"].n == 0 and found["a", "t"].n == 1 and found["b", "t"].quantiles is None
    stored = sketches.sketch_columns(rows, ["v", "t"], ["g"])
    assert {(r.g, r.column): r["p50"] for r in sketches.quantiles(stored, ["g", "column"], [0.5]).collect()} == {
        ("a", "v"): None, ("a", "t"): None, ("b", "v"): 1.0, ("b", "t"): None,
    }
    counts = {(r.g, r.column): r.distinct_values for r in sketches.distinct_counts(stored, ["g", "column"]).collect()}
    assert counts == {("a", "v"): 0, ("a", "t"): 1, ("b", "v"): 1, ("b", "t"): 1}  # an empty text is a value
    assert sketches.sketch_columns(rows.limit(0), ["v"], ["g"]).count() == 0


def test_distinct_counts_and_new_values_beyond_the_exact_range(spark):
    rows = spark.range(200_000).selectExpr("id AS v", "int(id / 50000) AS run")
    rows = rows.unionByName(rows.selectExpr("v", "run + 1 AS run"))  # each value is in two runs
    stored = sketches.sketch_columns(rows, ["v"], ["run"])
    for r in sketches.distinct_counts(stored, ["run"]).collect():
        exact = 50_000 if r.run in (0, 4) else 100_000
        assert abs(r.distinct_values - exact) < 4 * sketches.DISTINCT_ERROR * exact
    found = sketches.new_values(stored.filter("run <= 1"), stored.filter("run = 2"), ["column"]).first()
    assert abs(found.new_values - 50_000) < 8 * sketches.DISTINCT_ERROR * 100_000
    assert sketches.new_values(stored.limit(0), stored.filter("run = 0"), ["column"]).first().new_values == pytest.approx(50_000, rel=0.1)


@pytest.mark.parametrize(("rows", "repeats", "found"), [(1000, 0, 0), (1000, 1, 1), (200_000, 0, 0), (200_000, 40_000, 40_000)])
def test_unique_by_sketch(spark, rows, repeats, found):
    df = spark.range(rows).selectExpr(f"CASE WHEN id < {repeats} THEN id + {rows} - {repeats} ELSE id END AS v", "'x' AS t")
    spec = {"type": "unique", "columns": ["v"], "approx": True}
    row = R.rule_results(df, [spec]).first()
    exact = R.rule_results(df, [{**spec, "approx": False}]).first()
    assert exact.violation_count == repeats and row.passed == exact.passed == (not repeats)
    assert abs(row.violation_count - found) <= 3 * 2**-8 * rows * (rows > 2**16)
    plan = R.RuleSet.compile(df, [spec]).measures(False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan  # no value is shuffled


def test_unique_by_sketch_of_nulls_and_odd_values(spark):
    df = spark.createDataFrame(
        [(None, 0.0, ["a"]), (None, -0.0, ["a"]), ("", float("nan"), []), ("a", None, None), ("a", 1.0, ["b"])], "t string, f double, l array<string>"
    )
    for c in df.columns:
        spec = {"type": "unique", "columns": [c]}
        exact, near = (R.rule_results(df, [{**spec, "approx": a}]).first() for a in (False, True))
        assert exact.violation_count == near.violation_count, c
    empty = R.rule_results(df.limit(0), [{"type": "unique", "columns": ["t"], "approx": True}]).first()
    assert (empty.passed, empty.violation_count) == (True, 0)


def test_runs_keep_sketches_that_merge_over_any_range(spark, tmp_path, lake):
    for i in range(3):
        path = str(tmp_path / str(i))
        spark.range(100 * i, 100 * i + 150).selectExpr("id AS customer_id", "concat('m', id) AS email", "id * 1.5 AS spent").write.parquet(path)
        spec = PipelineSpec("p", {"type": "parquet", "path": path}, target="customers", order_by=["customer_id"], sketches=True)
        run_ingest(spark, lake, spec, f"r{i}", datetime(2024, 1, 1 + i))
    state = State(spark, lake)
    assert state.read("column_sketches").count() == 9
    row = {r.column: r for r in state.column_quantiles("customers", [0.5]).collect()}
    values = sorted(v * 1.5 for i in range(3) for v in range(100 * i, 100 * i + 150))
    assert row["spent"].n == 450 and abs(sum(v <= row["spent"].p50 for v in values) / 450 - 0.5) <= sketches.RANK_ERROR + 1 / 450
    assert row["email"].p50 is None
    new = {r.column: (round(r.distinct_values), round(r.new_values)) for r in state.values_new_in("customers", "r2").collect()}
    assert new["customer_id"] == new["email"] == (150, 100)
    assert state.column_quantiles("customers", [0.5], until=datetime(2020, 1, 1)).count() == 0
