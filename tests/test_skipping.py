"""Incremental reads of layers open only files that can have new rows, and lose none."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.lake import layers
from millrace.lake.skipping import IndexedLayer, index_run
from millrace.operators.incremental import filter_incremental
from millrace.plans.ingest import PipelineSpec, run_ingest

EVENTS = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    """A layer of one file a day."""
    lake = str(tmp_path_factory.mktemp("lake"))
    events = spark.read.parquet(EVENTS).withColumns({
        "said": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), "day": F.to_date("ts"), "code": F.lpad("event_id", 9, "0"),
        "share": F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("value")), "none": F.lit(None).cast("int"),
    })
    layers.write_layer_by_date(events, lake, "bronze", "events", "r 1+", F.col("ts"))
    index_run(spark, lake, "bronze", "events", "r 1+", ["ts", "said", "day", "code", "share", "event_id", "none"])
    return IndexedLayer(spark, lake, "bronze", "events")


def same(found, wanted):
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    a, b = (sorted(str(tuple(r)) for r in df.select(*columns).collect()) for df in (found, wanted))
    assert a == b
    return len(a)


@pytest.mark.parametrize(
    ("column", "watermark", "grace", "opened"),
    [
        ("ts", "2024-01-25 12:00:00", 0, 6), ("ts", "2024-01-25 12:00:00", 86400 * 3, 9), ("said", "2024-01-25T12:00:00", 0, 6),
        ("day", "2024-01-25", 0, 5), ("code", "not a time", 0, 0), ("ts", "2031-01-01", 0, 0), ("ts", "2001-01-01", 0, 30), ("none", "5", 0, 0),
        ("event_id", "700", 0, None), ("share", "99.5", 0, None), ("user_id", "3", 0, 30), ("dt", "2024-01-25", 0, 5),
    ],
)
def test_what_is_read_equals_a_filter_of_everything(layer, column, watermark, grace, opened):
    found = layer.newer(column, watermark, grace)
    n = same(found, filter_incremental(layer.rows(), column, watermark, grace))
    files = len(layer.rows().inputFiles())
    assert files == 30 and layer.schema is not None
    if opened is not None:
        used = found.inputFiles() if column != "dt" else found.select(F.input_file_name()).distinct().collect()
        assert len(used) == opened
    assert n or column in ("code", "none") or watermark == "2031-01-01"


def test_few_paths_stand_for_very_many_files(layer, monkeypatch):
    monkeypatch.setattr("millrace.lake.skipping.MOST_FILES", 3)
    found = layer.newer("ts", "2024-01-25 12:00:00")
    same(found, filter_incremental(layer.rows(), "ts", "2024-01-25 12:00:00"))
    assert len(found.inputFiles()) == 6


def test_runs_without_index_are_read_whole(spark, lake):
    rows = spark.createDataFrame([(i, datetime(2024, 1, 1 + i)) for i in range(6)], "id int, seen timestamp")
    for i in range(6):
        layers.write_layer(rows.filter(f"id = {i}").coalesce(1), lake, "silver", "d", f"r{i}", date(2024, 1, 1 + i))
        if i % 2:
            index_run(spark, lake, "silver", "d", f"r{i}")
    layer = IndexedLayer(spark, lake, "silver", "d")
    assert layer.schema is None and layer.count() == 6
    found = layer.newer("seen", "2024-01-04 00:00:00")
    assert same(found, filter_incremental(layer.rows(), "seen", "2024-01-04 00:00:00")) == 2
    assert len(found.inputFiles()) == 4  # r0, r2, r4 and r5, but neither r1 nor r3


def test_a_run_written_again_is_not_told_by_its_old_entry(spark, lake):
    old = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id int, seen timestamp")
    new = spark.createDataFrame([(2, datetime(2025, 1, 1))], "id int, seen timestamp")
    layers.write_layer(old, lake, "silver", "d", "r1", date(2024, 1, 1))
    index_run(spark, lake, "silver", "d", "r1")
    layers.write_layer(new, lake, "silver", "d", "r1", date(2024, 1, 1))
    assert [r.id for r in IndexedLayer(spark, lake, "silver", "d").newer("seen", "2024-06-01").collect()] == [2]
    index_run(spark, lake, "silver", "d", "r1")
    layers.discard_run(spark, lake, "silver", "d", "r1")
    assert IndexedLayer(spark, lake, "silver", "d").rows() is None


def test_columns_that_only_some_runs_have(spark, lake):
    layers.write_layer(spark.createDataFrame([(1,)], "id int"), lake, "silver", "d", "r1", date(2024, 1, 1))
    layers.write_layer(spark.createDataFrame([(2, 5, "x")], "id int, n int, t string"), lake, "silver", "d", "r2", date(2024, 1, 2))
    for run in ("r1", "r2"):
        index_run(spark, lake, "silver", "d", run)
    layer = IndexedLayer(spark, lake, "silver", "d")
    assert same(layer.newer("n", "4"), filter_incremental(layer.rows(), "n", "4")) == 1
    assert len(layer.newer("n", "4").inputFiles()) == 1
    # r1's file has no such column; that of r2 is not indexed by it, so it is read
    assert len(layer.newer("t", "a").inputFiles()) == 1 and layer.newer("t", "a").count() == 1


def test_a_pipeline_over_a_layer_opens_new_files_only(spark, tmp_path, lake):
    def first(i, rows):
        path = str(tmp_path / f"in{i}")
        spark.createDataFrame(rows, "customer_id int, email string, seen timestamp").coalesce(1).write.parquet(path)
        spec = PipelineSpec(
            "a", {"type": "parquet", "path": path}, target="customers", order_by=["customer_id"],
            incremental={"column": "seen", "initial_value": "2020-01-01"},
        )
        run_ingest(spark, lake, spec, f"a{i}", datetime(2024, 1, 1 + i))

    second = PipelineSpec(
        "b", {"type": "layer", "root": lake, "layer": "silver", "dataset": "customers"}, target="customers_scd2", order_by=["customer_id"],
        incremental={"column": "seen", "initial_value": "2020-01-01"},
    )
    first(1, [(1, "a", datetime(2024, 1, 1)), (2, "b", datetime(2024, 1, 2))])
    result = run_ingest(spark, lake, second, "b1", datetime(2024, 2, 1))
    assert (result.rows_extracted, result.rows_loaded, result.new_watermark) == (2, 2, "2024-01-02 00:00:00")
    first(2, [(3, "c", datetime(2024, 1, 5))])
    result = run_ingest(spark, lake, second, "b2", datetime(2024, 2, 2))
    assert (result.rows_extracted, result.rows_loaded) == (3, 1)
    layer = IndexedLayer(spark, lake, "silver", "customers")
    assert layer.schema is not None and len(layer.newer("seen", "2024-01-01 00:00:00").inputFiles()) == 2
    assert len(layer.newer("seen", "2024-01-03 00:00:00").inputFiles()) == 1
