"""End-to-end runs on small CSV files."""

from datetime import datetime

import pytest

from millrace.errors import LoadError, TransformError, ValidationFailed
from millrace.lake import layers, targets
from millrace.lake.state import State
from millrace.operators.dimension import DimensionSpec
from millrace.operators.lineage import lineage_graph
from millrace.plans.ingest import PipelineSpec, run_ingest, try_ingest

NOW = datetime(2024, 6, 1, 12)


def csv(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def file_spec(path, **kw):
    kw.setdefault("target", "customers")
    return PipelineSpec(name=kw.pop("name", "p"), source={"type": "file", "path": path}, source_name="crm", **kw)


CUSTOMERS = "customer_id,first_name,email,country\n1,Rhine,rhine@rivers.org,DE\n2,Loire,loire@rivers.org,FR\n"
RULES = {"rules": [
    {"type": "required_columns", "columns": ["email"]},
    {"type": "not_null", "columns": ["email"]},
    {"type": "unique", "columns": ["email"]},
]}


def test_clean_load_scores_and_layers(spark, lake, tmp_path):
    spec = file_spec(csv(tmp_path, "a.csv", CUSTOMERS), validation=RULES,
                     transform={"select": ["customer_id", "email"]})
    r = run_ingest(spark, lake, spec, "r1", NOW)
    assert (r.status, r.rows_extracted, r.rows_loaded) == ("SUCCEEDED", 2, 2)
    assert r.load_result == {"created": 2, "updated": 0}
    assert r.validation.overall_score == 100.0
    bronze = layers.read_layer(spark, lake, "bronze", "customers")
    assert set(bronze.columns) == {"customer_id", "first_name", "email", "country", "dt", "run_id"}
    silver = layers.preview(layers.read_layer(spark, lake, "silver", "customers"))
    assert len(silver) == 2 and "first_name" not in silver[0]
    gold = targets.open_dimension(spark, lake, "customers").current()
    assert {(g.external_id, g.first_name) for g in gold.collect()} == {("1", ""), ("2", "")}
    state = State(spark, lake)
    assert state.runs().first().status == "SUCCEEDED"
    assert state.runs().first().metrics["rows_loaded"] == 2.0


def test_dataset_without_target_is_named_after_the_pipeline(spark, lake, tmp_path):
    spec = file_spec(csv(tmp_path, "a.csv", CUSTOMERS), target=None, keep_raw=True,
                     transform={"clean": {"drop_rows_missing": ["email"]}})
    run_ingest(spark, lake, spec, "r1", NOW)
    assert State(spark, lake).read("datasets").first().name == "p"
    assert layers.read_layer(spark, lake, "raw", "p").count() == 2
    assert targets.open_dimension(spark, lake, "customers").current().count() == 2


def test_run_twice_loads_once(spark, lake, tmp_path):
    spec = file_spec(csv(tmp_path, "a.csv", CUSTOMERS))
    run_ingest(spark, lake, spec, "r1", NOW)
    again = run_ingest(spark, lake, spec, "r2", NOW)
    assert again.load_result == {"created": 0, "updated": 2}
    dim = targets.open_dimension(spark, lake, "customers")
    assert dim.current().count() == 2 and dim.latest_seq() == 2
    assert State(spark, lake).runs().count() == 2


def test_same_run_id_replaces_its_own_rows(spark, lake, tmp_path):
    """I5: a run that is started again with its id leaves one copy."""
    spec = file_spec(csv(tmp_path, "a.csv", CUSTOMERS))
    run_ingest(spark, lake, spec, "r1", NOW)
    run_ingest(spark, lake, spec, "r1", NOW)
    assert layers.read_layer(spark, lake, "bronze", "customers").count() == 2
    dim = targets.open_dimension(spark, lake, "customers")
    assert dim.current().count() == 2 and dim.latest_seq() == 1
    counted = {b.column: b["count"] for b in State(spark, lake).baseline("customers").collect()}
    assert counted == {"customer_id": 2}


def test_blocked_run_loads_nothing(spark, lake, tmp_path):
    spec = file_spec(csv(tmp_path, "a.csv", "customer_id,email\n1,\n2,b@x.com\n"), validation=RULES)
    with pytest.raises(ValidationFailed) as e:
        run_ingest(spark, lake, spec, "r1", NOW)
    assert e.value.outcome.completeness == 75.0
    state = State(spark, lake)
    assert state.runs().first().status == "FAILED"
    assert state.read("dead_letters").count() == 1
    card = state.read("scorecards").first()
    assert card.passed is False and card.checks[1].violation_count == 1
    assert layers.preview(layers.read_layer(spark, lake, "bronze", "customers")) == []
    assert targets.open_dimension(spark, lake, "customers").latest_seq() == 0
    assert state.read("schema_versions").count() == 0


def test_incremental_second_run(spark, lake, tmp_path):
    head = "customer_id,email,updated_at\n1,a@x.com,2024-01-01\n2,b@x.com,2024-01-02\n"
    path = csv(tmp_path, "a.csv", head)
    spec = file_spec(path, incremental={"column": "updated_at"})
    first = run_ingest(spark, lake, spec, "r1", NOW)
    assert first.rows_loaded == 2 and first.new_watermark == "2024-01-02"
    csv(tmp_path, "a.csv", head + "3,c@x.com,2024-01-03\n")
    second = run_ingest(spark, lake, spec, "r2", NOW)
    assert (second.rows_extracted, second.rows_loaded, second.new_watermark) == (3, 1, "2024-01-03")
    third = run_ingest(spark, lake, spec, "r3", NOW)
    assert (third.rows_loaded, third.new_watermark) == (0, "2024-01-03")


def test_watermark_does_not_move_back_with_grace(spark, lake, tmp_path):
    """D22."""
    path = csv(tmp_path, "a.csv", "customer_id,email,t\n1,a@x.com,2024-01-05 00:00:00\n")
    spec = file_spec(path, incremental={"column": "t", "grace_seconds": 3600})
    run_ingest(spark, lake, spec, "r1", NOW)
    csv(tmp_path, "a.csv", "customer_id,email,t\n2,b@x.com,2024-01-04 23:59:00\n")
    late = run_ingest(spark, lake, spec, "r2", NOW)
    assert late.rows_loaded == 1 and late.new_watermark == "2024-01-05 00:00:00"


def test_scd2_pipeline_keeps_history(spark, lake, tmp_path):
    path = csv(tmp_path, "a.csv", "customer_id,email,country\n1,a@x.com,UK\n")
    spec = file_spec(path, target="customers_scd2")
    run_ingest(spark, lake, spec, "r1", datetime(2024, 1, 1))
    csv(tmp_path, "a.csv", "customer_id,email,country\n1,a@x.com,US\n")
    r = run_ingest(spark, lake, spec, "r2", datetime(2024, 2, 1))
    assert r.load_result == {"created": 0, "updated": 1}
    dim = targets.open_dimension(spark, lake, "customers_scd2")
    rows = dim.history().orderBy("valid_from").collect()
    assert [(x.country, x.is_current) for x in rows] == [("UK", False), ("US", True)]
    assert rows[0].valid_to == rows[1].valid_from
    same = run_ingest(spark, lake, spec, "r3", datetime(2024, 3, 1))
    assert same.load_result == {"created": 0, "updated": 0}
    assert dim.history().count() == 2


def test_half_written_snapshot_is_invisible(spark, lake, tmp_path):
    spec = file_spec(csv(tmp_path, "a.csv", CUSTOMERS))
    run_ingest(spark, lake, spec, "r1", NOW)
    dim = targets.open_dimension(spark, lake, "customers")
    partial = f"{dim.folder}/data/00000002-r2/key_bucket=0"
    dim.current().limit(1).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(partial)
    assert dim.latest_seq() == 1 and dim.current().count() == 2


def test_dirty_rows_are_repaired_before_the_rules(spark, lake, tmp_path):
    text = "customer_id,email,country\n1,  Rhine@Rivers.org ,\n2,b@x.com,US\n2,b@x.com,US\n"
    spec = file_spec(
        csv(tmp_path, "a.csv", text),
        transform={"clean": {"trim": ["email"], "lowercase": ["email"], "fill_null": {"country": "UNKNOWN"}},
                   "drop_duplicates": ["customer_id"]},
        validation={"rules": [{"type": "not_null", "columns": ["country"]},
                              {"type": "no_duplicate_rows", "severity": "warning"}]},
    )
    r = run_ingest(spark, lake, spec, "r1", NOW)
    assert r.clean_stats == {"cells_trimmed": 1, "cells_lowercased": 1, "cells_filled": 1, "rows_dropped": 0}
    assert r.rows_loaded == 2 and r.validation.consistency < 100 and r.validation.passed
    gold = targets.open_dimension(spark, lake, "customers").current()
    assert {(g.email, g.country) for g in gold.collect()} == {("rhine@rivers.org", "UNKNOWN"), ("b@x.com", "US")}


def test_failures_end_in_a_terminal_state(spark, lake, tmp_path):
    path = csv(tmp_path, "a.csv", CUSTOMERS)
    with pytest.raises(LoadError):
        run_ingest(spark, lake, file_spec(path, target="nowhere"), "r1", NOW)
    with pytest.raises(TransformError):
        run_ingest(spark, lake, file_spec(path, transform={"select": ["nope"]}), "r2", NOW)
    with pytest.raises(TransformError):
        run_ingest(spark, lake, file_spec(path, transform={"cast": {"email": "int"}}), "r3", NOW)
    assert try_ingest(spark, lake, file_spec(str(tmp_path / "none.csv")), "r4", NOW, attempts=2).status == "FAILED"
    with pytest.raises(LoadError):
        run_ingest(spark, lake, file_spec(csv(tmp_path, "b.csv", "customer_id,x\n1,2\n")), "r5", NOW)
    state = State(spark, lake)
    assert {r.status for r in state.runs().collect()} == {"FAILED"}
    retried = state.read("run_events").filter("run_id = 'r4'").orderBy("event_ts").collect()
    assert [(e.status, e.retry_count) for e in retried] == [("RUNNING", 0), ("RETRYING", 1), ("RUNNING", 1), ("FAILED", 1)]
    assert state.read("dead_letters").filter("run_id = 'r4'").count() == 1


def test_schema_drift_and_rename(spark, lake, tmp_path):
    path = csv(tmp_path, "a.csv", "cust_id,email\n1,a@x.com\n")
    spec = file_spec(path, transform={"rename": {"cust_id": "customer_id"}})
    run_ingest(spark, lake, spec, "r1", NOW)
    run_ingest(spark, lake, spec, "r2", NOW)
    csv(tmp_path, "a.csv", "cust_id,email,country\n1,a@x.com,UK\n")
    run_ingest(spark, lake, spec, "r3", NOW)
    csv(tmp_path, "a.csv", "customer_id,email,country\n1,a@x.com,UK\n")
    run_ingest(spark, lake, spec, "r4", NOW)
    versions = State(spark, lake).read("schema_versions").orderBy("version").collect()
    assert [(v.version, v.is_drift, v.run_id) for v in versions] == [(1, False, "r1"), (2, True, "r3"), (3, True, "r4")]
    assert versions[1].added_columns == ["country"] and versions[1].removed_columns == []
    assert [tuple(x) for x in versions[2].renamed_columns] == [("cust_id", "customer_id")]
    assert versions[2].added_columns == [] and versions[2].removed_columns == []
    # the catalog knows the layer's columns, so a reader need not open the files for them
    known = State(spark, lake).layer_schema("customers")
    by_catalog = layers.read_layer(spark, lake, "bronze", "customers", known)
    merged = layers.read_layer(spark, lake, "bronze", "customers")
    assert set(by_catalog.dtypes) == set(merged.dtypes) and by_catalog.count() == 4
    names = sorted(merged.columns)
    assert sorted(map(str, by_catalog.select(names).collect())) == sorted(map(str, merged.select(names).collect()))


def test_anomaly_after_baseline(spark, lake, tmp_path):
    def text(values, start=1):
        return "customer_id,email,ltv\n" + "".join(f"{i},u{i}@x.com,{v}\n" for i, v in enumerate(values, start))

    path = csv(tmp_path, "a.csv", text([98, 100, 102, 99, 101]))
    spec = file_spec(path)
    run_ingest(spark, lake, spec, "r1", NOW)
    state = State(spark, lake)
    assert state.read("anomalies").count() == 0
    base = {b.column: b for b in state.baseline("customers").collect()}
    assert base["ltv"]["count"] == 5 and base["ltv"].mean == 100.0
    csv(tmp_path, "a.csv", text([500, 510, 490]))
    run_ingest(spark, lake, spec, "r2", NOW)
    flagged = state.read("anomalies").collect()
    assert [a.column for a in flagged] == ["ltv"] and abs(flagged[0].z_score) > 3
    assert {b.column: b["mean"] for b in state.baseline("customers").collect()}["ltv"] > 100


def test_lineage_of_two_pipelines(spark, lake, tmp_path):
    path = csv(tmp_path, "a.csv", CUSTOMERS)
    run_ingest(spark, lake, file_spec(path), "r1", NOW)
    other = file_spec(path, name="q")
    other.source_name = "shop"
    run_ingest(spark, lake, other, "r2", NOW)
    run_ingest(spark, lake, other, "r3", NOW)
    edges = State(spark, lake).latest(
        "lineage", ["pipeline", "from_layer", "from_name", "to_layer", "to_name"], "recorded_at")
    graph = lineage_graph(edges.drop("recorded_at"), "customers")
    assert [n["layer"] for n in graph["nodes"]] == ["SOURCE", "SOURCE", "BRONZE", "SILVER", "GOLD"]
    assert len(graph["edges"]) == 6


def test_custom_target(spark, lake, tmp_path):
    """L3: a target is a loader and a table shape."""
    spec = DimensionSpec(key="sku", source_key="id", tracked=("price",), carried=(), required=(), types={"price": "double"},
                         defaults={}, column_order=())
    targets.register_target("parts", targets.Target("parts", targets.load_type2, spec))
    path = csv(tmp_path, "a.csv", "id,price\n1,1.5\n1,2.5\n2,3.0\n")
    r = run_ingest(spark, lake, file_spec(path, target="parts"), "r1", NOW)
    assert r.load_result == {"created": 2, "updated": 1}
    dim = targets.open_dimension(spark, lake, "parts")
    assert dim.current().count() == 2 and dim.history().count() == 3
    assert {(x.sku, x.price) for x in dim.current().collect()} == {("1", 2.5), ("2", 3.0)}


def test_killed_run_is_started_again(spark, lake, tmp_path, monkeypatch):
    """I5: the driver dies after the load; the same run id brings every row exactly once."""
    path = tmp_path / "big.csv"
    with path.open("w") as f:
        f.write("customer_id,first_name,last_name,email,signup_date,country\n")
        f.writelines(f"chaos-{i % 15000},n{i},T,u{i}@x.com,2024-01-01,US\n" for i in range(20000))
    spec = file_spec(str(path), target="customers_scd2")

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr("millrace.plans.ingest.IngestRun.record", die)
        with pytest.raises(KeyboardInterrupt):
            run_ingest(spark, lake, spec, "r1", NOW)
    state = State(spark, lake)
    assert state.runs().first().status == "RUNNING"
    r = run_ingest(spark, lake, spec, "r1", datetime(2024, 6, 2))
    for layer in ("bronze", "silver"):  # the attempt of the day before left nothing behind
        assert layers.read_layer(spark, lake, layer, "customers_scd2").count() == 20000
    dim = targets.open_dimension(spark, lake, "customers_scd2")
    assert (r.status, r.rows_loaded, dim.latest_seq()) == ("SUCCEEDED", 20000, 1)
    assert dim.current().count() == 15000 and dim.history().count() == 20000
    last = dim.current().filter("external_id = 'chaos-7'").first()
    assert last.first_name == "n15007"
    assert state.runs().first().status == "SUCCEEDED"


def test_initial_watermark_and_failure_before_it_moves(spark, lake, tmp_path, monkeypatch):
    """D25: the watermark is the last thing a run writes."""
    path = csv(tmp_path, "a.csv", "customer_id,email,updated_at\n1,a@x.com,2024-01-01\n2,b@x.com,2024-01-02\n")
    spec = file_spec(path, incremental={"column": "updated_at", "initial_value": "2024-01-01"})

    def refuse(*args):
        raise LoadError("target is down")

    with monkeypatch.context() as m:
        m.setattr("millrace.lake.targets.load", refuse)
        assert try_ingest(spark, lake, spec, "r1", NOW).error == "target is down"
    state = State(spark, lake)
    assert state.watermark("p") is None and state.read("schema_versions").count() == 0
    assert all(layers.read_layer(spark, lake, layer, "customers") is None for layer in ("bronze", "silver"))
    r = run_ingest(spark, lake, spec, "r2", NOW)
    assert (r.rows_extracted, r.rows_loaded, r.new_watermark) == (2, 1, "2024-01-02")
    assert state.watermark("p").value == "2024-01-02"


def test_two_targets_share_one_table(spark, lake):
    """A11."""
    a, b = (targets.open_dimension(spark, lake, n) for n in ("customers", "customers_scd2"))
    assert a.folder == b.folder and a.current().columns == list(a.spec.columns)
