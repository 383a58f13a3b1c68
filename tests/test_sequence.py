"""Ordered work per key: the cut path for hot keys against the plain path and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.dimension import (
    CUSTOMERS, DimensionSpec, keys_fit_broadcast, merge_counts, merge_type2, untouched_rows, upsert_counts, upsert_type1,
)
from millrace.operators.drift import schema_drift
from millrace.operators.sequence import along_key, pieces_needed
from millrace.operators.statistics import (
    STATS_SCHEMA, backtest, column_moments, judge_and_merge, merge_baseline, z_scores,
)
from millrace.session import local_frame
from datetime import datetime

NOW, LATER = datetime(2024, 1, 1), datetime(2024, 2, 1)
SPEC = DimensionSpec(
    key="external_id", source_key="k", tracked=("a", "b"), carried=("c",), required=("a",), types={},
    defaults={"b": ""}, column_order=(),
)


def skewed(spark, n=400, seed=1):
    """A third of all rows under one key, some values NULL, some keys NULL."""
    r = random.Random(seed)
    rows = [
        (None if r.random() < 0.05 else "hot" if r.random() < 0.35 else f"k{r.randrange(30)}",
         i, r.choice([None, "x", "y"]), r.choice(["p", "q"]), r.randrange(100) / 4)
        for i in range(n)
    ]
    r.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t int, a string, b string, v double"), rows


def test_pieces_needed(spark):
    df, rows = skewed(spark)
    assert pieces_needed(df, ["k"], 10**6) == 0
    assert pieces_needed(df, ["k"], 50) == 8
    assert pieces_needed(df.limit(0), ["k"], 50) == 0


@pytest.mark.parametrize("pieces", [0, 7])
def test_along_key_equals_brute_force(spark, pieces):
    df, rows = skewed(spark)
    got = along_key(
        df, ["k"], ["t"], pieces=pieces, previous={"before": F.struct("a", "v")},
        following={"after": F.struct("a")}, first={"origin": F.struct("b", "t")}, sums_before={"total": F.col("v")},
    )
    assert got.columns == [*df.columns, "before", "after", "origin", "total"]
    want = set()
    for k in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        for i, r in enumerate(mine):
            before, after = (mine[i - 1] if i else None), (mine[i + 1] if i + 1 < len(mine) else None)
            want.add((*r, before and (before[2], before[4]), after and (after[2],), (mine[0][3], mine[0][1]),
                      sum(x[4] for x in mine[:i]) if i else None))
    found = {
        tuple(tuple(x) if hasattr(x, "__fields__") else x for x in row) for row in got.collect()
    }
    assert found == want


def test_pieces_follow_a_struct_order(spark):
    """The file position of CSV rows is a struct."""
    df, _ = skewed(spark, n=200)
    placed = df.withColumn("_pos", F.struct(F.lit("f").alias("file"), F.col("t").alias("row")))
    args = dict(previous={"before": F.struct("t")}, following={"after": F.struct("t")})
    cut, plain = (along_key(placed, ["k"], ["_pos"], pieces=p, **args) for p in (5, 0))
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))


def replay(current, batch, now):
    """Row-by-row Type-2 load."""
    table = [dict(r) for r in current]
    created = changed = 0
    for row in batch:
        mine = next((t for t in table if t["external_id"] == row["k"] and t["is_current"]), None)
        values = {"a": row["a"], "b": row["b"]}
        if mine is None:
            table.append({"external_id": row["k"], **values, "c": row["c"] or None, "valid_from": now, "valid_to": None, "is_current": True})
            created += 1
        elif {x: mine[x] for x in values} != values:
            mine.update(valid_to=now, is_current=False)
            table.append({"external_id": row["k"], **values, "c": mine["c"], "valid_from": now, "valid_to": None, "is_current": True})
            changed += 1
    return table, created, changed


def as_set(rows):
    return sorted((str(tuple(r[c] for c in SPEC.columns))) for r in rows)


@pytest.mark.parametrize("hot_key_rows", [10**6, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_type2_equals_row_by_row(spark, seed, hot_key_rows):
    """D29-D31, with many rows per key, NULL attributes and a hot key."""
    r = random.Random(seed)

    def batch(n):
        return [
            {"k": "hot" if r.random() < 0.4 else f"k{r.randrange(12)}", "t": i, "a": r.choice([None, "x", "y"]),
             "b": r.choice(["p", "q"]), "c": r.choice(["", "s1", "s2"])}
            for i in range(n)
        ]

    schema = "k string, t int, a string, b string, c string"
    first, second = batch(120), batch(80)
    empty = local_frame(spark, [], SPEC.schema)

    def frame(rows):
        shuffled = rows[:]
        r.shuffle(shuffled)
        return spark.createDataFrame([tuple(x.values()) for x in shuffled], schema)

    v1 = merge_type2(empty, frame(first), SPEC, ["t"], NOW, hot_key_rows=hot_key_rows).cache()
    want, created, changed = replay([], first, NOW)
    assert as_set(v1.collect()) == as_set(want)
    assert tuple(merge_counts(v1).first()) == (created, changed)

    current = v1.filter("is_current").select(*SPEC.columns)
    v2 = merge_type2(current, frame(second), SPEC, ["t"], LATER, hot_key_rows=hot_key_rows).cache()
    want, created, changed = replay([x for x in want if x["is_current"]], second, LATER)
    whole = v2.select(*SPEC.columns).unionByName(untouched_rows(current, frame(second), SPEC))
    assert as_set(whole.collect()) == as_set(want)
    assert tuple(merge_counts(v2).first()) == (created, changed)

    collapsed = merge_type2(current, frame(second), SPEC, ["t"], LATER, collapse=True)
    last = {x["k"]: x for x in second}
    want, *_ = replay([x.asDict() for x in current.collect()], last.values(), LATER)
    whole = collapsed.select(*SPEC.columns).unionByName(untouched_rows(current, frame(second), SPEC))
    assert as_set(whole.collect()) == as_set(want)


def test_type1(spark):
    batch = spark.createDataFrame([(1, "Ada", "a@x.com", 1), (1, "Ada B", "b@x.com", 2)],
                                  "customer_id int, first_name string, email string, t int")
    empty = local_frame(spark, [], CUSTOMERS.schema)
    assert tuple(upsert_counts(empty, batch, CUSTOMERS).first()) == (1, 1)
    once = upsert_type1(empty, batch, CUSTOMERS, ["t"], NOW)
    row = once.first()
    assert (row.external_id, row.first_name, row.last_name, row.signup_date, row.country) == ("1", "Ada B", "", None, "")
    assert tuple(upsert_counts(once, batch, CUSTOMERS).first()) == (0, 2)
    twice = upsert_type1(once, batch, CUSTOMERS, ["t"], LATER)
    assert [tuple(r) for r in twice.collect()] == [tuple(row)]
    assert row.valid_from == NOW and row.is_current


def test_rows_without_a_key_load_once(spark):
    batch = spark.createDataFrame([(None, "Ada", "a@x.com", 1), (None, "Ada B", "b@x.com", 2)],
                                  "customer_id int, first_name string, email string, t int")
    table = local_frame(spark, [], CUSTOMERS.schema)
    for _ in range(2):
        table = upsert_type1(table, batch, CUSTOMERS, ["t"], NOW)
    assert [(r.external_id, r.first_name) for r in table.collect()] == [("", "Ada B")]
    again = merge_type2(table, batch.filter("t = 2"), CUSTOMERS, ["t"], LATER)
    assert tuple(merge_counts(again).first()) == (0, 0)


def test_small_batches_leave_the_dimension_in_place(spark, tmp_path):
    """Neither join moves the big side when the batch is small."""
    path = str(tmp_path / "dim")
    spark.range(1000).selectExpr(
        "cast(id AS string) AS external_id", "'a' AS a", "'b' AS b", "'c' AS c",
        "timestamp'2024-01-01' AS valid_from", "cast(null AS timestamp) AS valid_to", "true AS is_current",
    ).write.parquet(path)
    batch = spark.createDataFrame([("1", 1, "x", "y", "z")], "k string, t int, a string, b string, c string")
    dim = spark.read.parquet(path)
    assert keys_fit_broadcast(batch, SPEC) and not keys_fit_broadcast(batch, SPEC, limit=1)
    out = upsert_type1(dim, batch, SPEC, ["t"], NOW, broadcast_keys=True)
    assert out.count() == 1000
    for frame in (out, untouched_rows(dim, batch, SPEC, broadcast_keys=True)):
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [external_id" in plan and "LeftAnti, BuildRight" in plan


def sequential(history):
    """The baseline merge run by run."""
    out, count, mean, m2 = [], 0, 0.0, 0.0
    for n, m, v in history:
        sd = (m2 / count) ** 0.5 if count else 0.0
        z = (m - mean) / sd if count >= 3 and sd > 1e-9 else None
        out.append((count, z, z is not None and abs(z) > 3))
        total, delta = count + n, m - mean
        m2 += v * n + delta**2 * count * n / total
        mean += delta * n / total
        count = total
    return out


@pytest.mark.parametrize("hot_key_rows", [10**6, 10])
def test_backtest_equals_the_sequential_merge(spark, hot_key_rows):
    r = random.Random(3)
    rows = [
        ("hot" if i % 3 == 0 else f"c{i % 5}", i, r.randrange(1, 6), 1e6 + r.gauss(0, 2) + (900 if i == 90 else 0), r.random())
        for i in range(120)
    ]
    df = spark.createDataFrame(rows, "col string, run int, count bigint, mean double, variance double")
    got = {(x.col, x.run): x for x in backtest(df, ["col"], ["run"], hot_key_rows=hot_key_rows).collect()}
    for key in {x[0] for x in rows}:
        mine = sorted((x for x in rows if x[0] == key), key=lambda x: x[1])
        for x, (count, z, flag) in zip(mine, sequential([m[2:] for m in mine])):
            g = got[(key, x[1])]
            assert g.baseline_count == count and g.is_anomaly == flag
            assert (g.z_score is None) == (z is None) and (z is None or abs(g.z_score - z) < 1e-4 * max(1, abs(z)))
    assert got[("hot", 90)].is_anomaly


def test_moments_merge_like_one_batch(spark):
    df = spark.createDataFrame([(98, True, "x", 1.5), (100, False, "y", float("nan")), (102, None, "z", 2.5)],
                               "a int, b boolean, s string, x double")
    found = {r.column: tuple(r)[1:] for r in column_moments(df).collect()}
    assert set(found) == {"a", "b", "x"}
    assert found["a"] == (3, 100.0, pytest.approx(8 / 3)) and found["x"] == (2, 2.0, 0.25) and found["b"][0] == 2
    keys = ["dataset", "column"]
    empty = local_frame(spark, [], STATS_SCHEMA)
    m1 = spark.createDataFrame([("d", "a", 5, 100.0, 2.0)], "dataset string, column string, count bigint, mean double, variance double")
    base = merge_baseline(m1, empty, keys)
    assert tuple(base.first())[2:] == (5, 100.0, 10.0)
    assert not z_scores(m1, empty, keys).first().is_anomaly
    far = m1.withColumns({"count": F.lit(3).cast("bigint"), "mean": F.lit(500.0)})
    judged = judge_and_merge(far, base, keys).first()
    assert judged.is_anomaly and judged["count"] == 8 and judged["mean"] == 250.0 and judged.baseline_mean == 100.0
    other = merge_baseline(m1.withColumn("column", F.lit("new")), base, keys)
    assert {r.column for r in other.collect()} == {"a", "new"}


@pytest.mark.parametrize("hot_key_rows", [10**6, 3])
def test_schema_history(spark, hot_key_rows):
    history = [(1, "cust_id"), (1, "email"), (2, "email"), (2, "cust_id"), (3, "cust_id"), (3, "email"), (3, "country"),
               (4, "customer_id"), (4, "email"), (4, "country"), (5, "email")]
    rows = [("d", run, name) for run, name in history] + [("e", 1, "z")]
    df = spark.createDataFrame(rows, "dataset string, run int, name string")
    got = schema_drift(df, ["dataset"], "run", "name", {"cust_id": "customer_id"}, hot_key_rows=hot_key_rows)
    found = [(r.dataset, r.run, r.version, r.added, r.removed, [tuple(x) for x in r.renamed], r.is_drift)
             for r in got.orderBy("dataset", "run").collect()]
    assert found == [
        ("d", 1, 1, [], [], [], False),
        ("d", 3, 2, ["country"], [], [], True),
        ("d", 4, 3, [], [], [("cust_id", "customer_id")], True),
        ("d", 5, 4, [], ["country", "customer_id"], [], True),
        ("e", 1, 1, [], [], [], False),
    ]


def test_numeric_keys_become_plain_text(spark):
    """D35: 1 stays "1", also where another key is missing."""
    batch = spark.createDataFrame([(1, "a@x.com", 1), (None, "b@x.com", 2)], "customer_id bigint, email string, t int")
    table = upsert_type1(local_frame(spark, [], CUSTOMERS.schema), batch, CUSTOMERS, ["t"], NOW)
    assert {r.external_id for r in table.collect()} == {"1", ""}
