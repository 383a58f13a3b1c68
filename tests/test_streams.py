"""Keyed stream state and admission once."""

import math
from datetime import datetime, timedelta

import pytest

from millrace.operators.statistics import merge_baseline
from millrace.streaming.admission import admit_once
from millrace.streaming.keyed import collect_baselines, keyed_baselines, merged_moments, task_moments

SCHEMA = "id bigint, dataset string, v double, w int"


def land(spark, root, rows, files=1):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(f"{root}/in")


def collect(spark, root):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
    return {(r.dataset, r.column): r for r in collect_baselines(keyed_baselines(stream, "dataset"), f"{root}/cp", f"{root}/told").collect()}


def plain(rows, dataset, at):
    values = [r[at] for r in rows if r[1] == dataset and r[at] is not None and not math.isnan(r[at])]
    mean = sum(values) / len(values)
    return len(values), mean, sum((v - mean) ** 2 for v in values)


def test_moments_over_many_files_and_triggers(spark, tmp_path):
    first = [(i, "hot" if i % 3 else "b", float(i % 17), i % 5) for i in range(600)] + [(1, None, 5.0, 5), (2, "b", float("nan"), None), (3, "n", None, None)]
    second = [(i, "hot", 1000.0 + i % 3, 2) for i in range(50)] + [(5, "c", 7.0, 1)]
    land(spark, tmp_path, first, 5)
    found = collect(spark, tmp_path)
    assert set(found) == {(d, c) for d in ("hot", "b") for c in ("id", "v", "w")} | {("n", "id")}
    assert found["hot", "v"].z_score is None
    land(spark, tmp_path, second, 3)
    found = collect(spark, tmp_path)
    for dataset in ("hot", "b", "c"):
        for column, at in (("id", 0), ("v", 2), ("w", 3)):
            row = found[dataset, column]
            assert (row["count"], row["mean"], row.m2) == pytest.approx(plain(first + second, dataset, at), rel=1e-9, abs=1e-9)
    n, mean, m2 = plain(first, "hot", 2)
    row = found["hot", "v"]
    assert row.value == pytest.approx(plain(second, "hot", 2)[1]) and row.is_anomaly
    assert row.z_score == pytest.approx((row.value - mean) / (m2 / n) ** 0.5)
    assert found["c", "v"].z_score is None and not found["c", "v"].is_anomaly
    assert collect(spark, tmp_path)["hot", "v"]["count"] == row["count"]  # nothing new


def test_merging_equals_the_batch_operator(spark):
    a, b = (3, 2.0, 4.0), (5, -1.0, 0.5)
    kind = "column string, count bigint, mean double, variance double"
    base = spark.createDataFrame([("x", 3, 2.0, 4.0)], "column string, count bigint, mean double, m2 double")
    row = merge_baseline(spark.createDataFrame([("x", 5, -1.0, 0.1)], kind), base, ["column"]).first()
    assert merged_moments(a, b) == pytest.approx((row["count"], row["mean"], row.m2))
    assert merged_moments((0, 0.0, 0.0), (0, 0.0, 0.0)) == (0, 0.0, 0.0)
    assert next(task_moments(iter([]))).empty


START = datetime(2024, 1, 1)


def admitted(spark, root, rows=None, lateness="1 hour"):
    kind = "k int, ts timestamp, v string"
    if rows is not None:
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(kind).parquet(f"{root}/in")
    found = admit_once(stream, ["k"], "ts", lateness, f"{root}/cp", f"{root}/table")
    return sorted(((r.k is None, r.k, r.v) for r in found.collect()), key=str)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_replayed_and_late_files_give_the_table_of_one_pass(spark, tmp_path):
    a = [(i, at(i), "a") for i in range(5)]
    late = [(i, at(i), "late") for i in range(3, 9)] + [(100, at(-3000), "very late"), (None, at(2), "no key")]
    far = [(i, at(10_000 + i), "far") for i in range(20, 23)]
    admitted(spark, f"{tmp_path}/x", a)
    admitted(spark, f"{tmp_path}/x", far)
    admitted(spark, f"{tmp_path}/x", far + [(50, at(10_001), "in time")])
    admitted(spark, f"{tmp_path}/x", late)
    found = admitted(spark, f"{tmp_path}/x", a + late)
    kept = {k for _, k, _ in found}
    assert len(found) == len(kept) == 5 + 4 + 1 + 1 + 3 + 1
    assert {v for _, k, v in found if k is not None and k < 5} == {"a"} and (False, 100, "very late") in found
    assert spark.read.parquet(f"{tmp_path}/x/table/late").count() == 6
    assert admitted(spark, f"{tmp_path}/x") == found


def test_rows_without_time_and_repeats_within_a_file(spark, tmp_path):
    found = admitted(spark, str(tmp_path), [(1, None, "x"), (1, None, "x"), (2, at(1), "y"), (2, at(1), "y")])
    assert found == [(False, 1, "x"), (False, 2, "y")]


def test_a_repeated_batch_replaces_what_it_wrote(spark, tmp_path):
    root = str(tmp_path)
    first = admitted(spark, root, [(1, at(1), "a"), (2, at(500), "b")])
    # as after a crash between the sink and the commit of the stream's last batch
    for part in ("main", "late"):
        for commit in (tmp_path / "cp" / part / "commits").glob("[0-9]*"):
            commit.unlink()
        for crc in (tmp_path / "cp" / part / "commits").glob(".*.crc"):
            crc.unlink()
    assert admitted(spark, root) == first
