"""Readers, layers, streams, ledger and serving."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from millrace.errors import ExtractError, LoadError
from millrace.lake import layers, targets
from millrace.lake.state import State
from millrace.operators import ledger
from millrace.operators.lineage import edges_of_dataset, lineage_edges, lineage_graph, lineage_nodes
from millrace.operators.serve import masked, matching, page, page_after, visible_to
from millrace.sources import POSITION, extract, register_source, source_types
from millrace.sources.csv import read_csv, resolve_path
from millrace.sources.jdbc import bind, connection_options, reader_options
from millrace.sources.objects import object_options, object_uri
from millrace.sources.pages import landed_pages, page_columns, page_drift
from millrace.streaming.baseline import stream_baseline
from millrace.streaming.poll import poll_files
from millrace.streaming.rates import stream_rate


def put(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def rows(df):
    return [tuple(r) for r in df.drop(POSITION).collect()]


# CSV

def test_csv_types_and_missing(spark, tmp_path):
    path = put(tmp_path, "a.csv", "id,x,ok,name,day,none,big\n1,1.5,True,a,2024-01-01,,99999999999999999999\n"
                                  "2,NA,False,-,2024-01-02,null,1\n,3,,\"q, \"\"w\"\"\",,n/a,2\n")
    df = extract(spark, "file", {"path": path})
    assert dict(df.drop(POSITION).dtypes) == {
        "id": "bigint", "x": "double", "ok": "boolean", "name": "string", "day": "string", "none": "double", "big": "string"}
    assert rows(df) == [(1, 1.5, True, "a", "2024-01-01", None, "99999999999999999999"), (2, None, False, "-", "2024-01-02", None, "1"),
                        (None, 3.0, None, 'q, "w"', None, None, "2")]


def test_csv_short_rows_pad_and_long_rows_fail(spark, tmp_path):
    """D4."""
    assert rows(read_csv(spark, put(tmp_path, "a.csv", "a,b\n1\n2,x\n"))) == [(1, None), (2, "x")]
    long = put(tmp_path, "b.csv", "a,b\n1,2,3\n")
    with pytest.raises(ExtractError, match="more fields"):
        read_csv(spark, long)
    with pytest.raises(PySparkException):
        read_csv(spark, long, schema="a int, b int").collect()


def test_csv_cells_with_line_breaks(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'a,b\n1,"two\nlines"\n2,x\n')
    assert rows(read_csv(spark, path)) == [(1, "two\nlines"), (2, "x")]


def test_csv_given_schema(spark, tmp_path):
    path = put(tmp_path, "a.csv", "a,b,c\n1,2024-01-01,z\n")
    df = read_csv(spark, path, schema="b date, a int")
    assert rows(df) == [(1, date(2024, 1, 1))]
    with pytest.raises(ExtractError, match="nope"):
        read_csv(spark, path, schema="nope int")


def test_csv_position_follows_the_file(spark, tmp_path):
    """D2: rows can be put back in file order after any shuffle."""
    body = "".join(f"{i},{'x' * (i % 50)}\n" for i in range(2000))
    path = put(tmp_path, "a.csv", "n,s\n" + body)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = read_csv(spark, path)
        assert df.rdd.getNumPartitions() > 3
        got = [r.n for r in df.repartition(5).orderBy(POSITION).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == list(range(2000))


def test_csv_errors(spark, tmp_path):
    for config in ({}, {"path": str(tmp_path / "none.csv")}, {"path": put(tmp_path, "empty.csv", "")}):
        with pytest.raises(ExtractError):
            extract(spark, "file", config)
    assert extract(spark, "file", {"path": put(tmp_path, "head.csv", "a,b\n")}).count() == 0


def test_relative_paths(spark, tmp_path):
    put(tmp_path, "in/a.csv", "a\n1\n")
    assert rows(extract(spark, "file", {"path": "in/a.csv", "base_dir": str(tmp_path)})) == [(1,)]
    assert resolve_path("/x/a.csv", "/base") == "/x/a.csv"
    assert resolve_path("s3a://b/a.csv", "/base") == "s3a://b/a.csv"


def test_unknown_source_and_custom_source(spark):
    with pytest.raises(ExtractError, match="carrier pigeon"):
        extract(spark, "carrier pigeon", {})
    with pytest.raises(ExtractError):
        extract(spark, None, {})
    register_source("numbers", lambda spark, config: spark.range(config["n"]))
    assert extract(spark, "NUMBERS", {"n": 3}).count() == 3
    assert {"file", "postgres", "rest_api", "s3", "numbers"} <= set(source_types())


def test_custom_format_as_a_source(spark):
    """L4: a Python data source becomes a source type."""

    class Squares(DataSource):
        @classmethod
        def name(cls):
            return "squares"

        def schema(self):
            return "n int, square int"

        def reader(self, schema):
            upto = int(self.options["upto"])

            class Reader(DataSourceReader):
                def partitions(self):
                    return [InputPartition(i) for i in range(upto)]

                def read(self, partition):
                    yield (partition.value, partition.value**2)

            return Reader()

    spark.dataSource.register(Squares)
    register_source("squares", lambda spark, config: spark.read.format("squares").options(**config).load())
    assert rows(extract(spark, "squares", {"upto": "3"})) == [(0, 0), (1, 1), (2, 4)]


def test_one_odd_quote_makes_one_file_unsplittable(spark, tmp_path):
    big = tmp_path / "in" / "a b.csv"
    put(tmp_path, "in/a b.csv", "id,note\n" + "".join(f"{i},n{i}\n" for i in range(40_000)))
    put(tmp_path, "in/odd.csv", 'id,note\n90001,"two\nlines"\n90002,x\n')
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(big.stat().st_size // 3))
    try:
        df = extract(spark, "file", {"path": str(tmp_path / "in")})
        assert df.rdd.getNumPartitions() >= 4
        assert df.agg(F.count("id"), F.countDistinct(POSITION), F.sum("id")).first() == (40_002, 40_002, 40_000 * 39_999 // 2 + 180_003)
        assert [r.note for r in df.filter("id > 90000").orderBy(POSITION).collect()] == ["two\nlines", "x"]
        first = df.orderBy(POSITION).limit(3).collect()
        assert [r.id for r in first] == [0, 1, 2] and dict(df.dtypes)["id"] == "bigint"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


# paged JSON

def pages(tmp_path, *texts):
    for i, text in enumerate(texts, 1):
        put(tmp_path, f"page-{i:03d}.json", text)
    return str(tmp_path)


def test_pages_stop_at_the_first_empty_one(spark, tmp_path):
    path = pages(tmp_path, '[{"id": 1}, {"id": 2}]', '[\n {"id": 3}\n]', "[]", '[{"id": 9}]')
    df = extract(spark, "rest_api", {"path": path})
    assert [r.id for r in df.orderBy(POSITION).collect()] == [1, 2, 3]


def test_pages_limit_and_start(spark, tmp_path):
    path = pages(tmp_path, *[f'{{"data": [{{"id": {i}, "tag": {{"k": [1]}}}}]}}' for i in range(1, 6)])
    config = {"path": path, "results_path": "data"}
    df = extract(spark, "rest_api", config)
    assert sorted(r.id for r in df.collect()) == [1, 2, 3, 4, 5] and df.first().tag.k == [1]
    config["pagination"] = {"start_page": 4, "max_pages": 3}
    assert sorted(r.id for r in extract(spark, "rest_api", config).collect()) == [4, 5]
    config["pagination"] = {"max_pages": 3}
    with pytest.raises(ExtractError, match="5 pages"):
        extract(spark, "rest_api", config)


def test_a_missing_page_is_an_error(spark, tmp_path):
    pages(tmp_path, '[{"id": 1}]', '[{"id": 2}]', '[{"id": 3}]', '[{"id": 4}]', "[]")
    (tmp_path / "page-003.json").unlink()
    with pytest.raises(ExtractError, match="page 3 is missing"):
        extract(spark, "rest_api", {"path": str(tmp_path)})


def test_pages_must_hold_lists(spark, tmp_path):
    with pytest.raises(ExtractError, match="page 1"):
        extract(spark, "rest_api", {"path": pages(tmp_path, '{"not": "a list"}')})
    with pytest.raises(ExtractError):
        extract(spark, "rest_api", {"path": str(tmp_path), "results_path": "data"})
    with pytest.raises(ExtractError):
        extract(spark, "rest_api", {})


def test_pages_that_differ(spark, tmp_path):
    path = pages(
        tmp_path, '{"data": [{"id": 1, "b": 1.5, "t": {"k": [1]}}, {"id": "x", "c": null, "a b": true}]}',
        '{"data": [{"id": 7, "d": "2024-01-01", "t": 5}, 3, {}]}', '{"data": [{"id": 12345678901234567890}]}', '{"data": []}', "broken",
    )
    config = {"path": path, "results_path": "data"}
    df = extract(spark, "rest_api", config)
    assert dict(df.drop(POSITION).dtypes) == {"a b": "boolean", "b": "double", "c": "string", "d": "string", "id": "string", "t": "string"}
    found = [tuple(r)[:-1] for r in df.orderBy(POSITION).collect()]
    none = (None,) * 6
    assert found == [
        (None, 1.5, None, None, "1", '{"k":[1]}'), (True, None, None, None, "x", None), (None, None, None, "2024-01-01", "7", "5"),
        none, none, (None, None, None, None, "12345678901234567890", None),
    ]
    typed = extract(spark, "rest_api", {**config, "schema": "id bigint, d date, t struct<k: array<int>>"}).orderBy(POSITION).collect()
    assert [(r.id, str(r.d), r.t and r.t.k) for r in typed[:3]] == [(1, "None", [1]), (None, "None", None), (7, "2024-01-01", None)]
    drift = page_drift(page_columns(landed_pages(spark, config)))
    assert sorted((r.page, r.name, r.change) for r in drift.collect()) == [
        (2, "a b", "removed"), (2, "b", "removed"), (2, "c", "removed"), (2, "d", "added"), (2, "id", "type"), (2, "t", "type"),
        (3, "d", "removed"), (3, "id", "type"), (3, "t", "removed"),
    ]


def test_names_that_look_like_types(spark, tmp_path):
    path = pages(tmp_path, '[{"VOID": 1, "DECIMAL(1,0)": {"VARIANT": 2.5, "e": {}, "n": null}, "l": [null, {"VOID": null}]}]')
    df = extract(spark, "rest_api", {"path": path}).drop(POSITION)
    assert df.dtypes == [("DECIMAL(1,0)", "struct<VARIANT:double,e:string,n:string>"), ("VOID", "bigint"), ("l", "array<struct<VOID:string>>")]
    assert df.first()["DECIMAL(1,0)"].VARIANT == 2.5


def test_page_files_are_read_once(spark, tmp_path, monkeypatch):
    path = pages(tmp_path, '[{"id": 1}]', '[{"id": 2}]')
    df = extract(spark, "rest_api", {"path": path})
    for file in tmp_path.glob("page-*.json"):
        file.unlink()
    assert sorted(r.id for r in df.collect()) == [1, 2]
    assert "Scan text" not in df._jdf.queryExecution().toString() and "Scan json" not in df._jdf.queryExecution().toString()


# SQL and object stores: the options only, as neither a database nor a store is at hand

def test_jdbc_options():
    options = reader_options({
        "dsn": "postgresql://ann:p%40ss@db:5433/shop?sslmode=require", "query": "SELECT * FROM t WHERE a = %s AND b = %(b)s;",
        "params": None, "partition_column": "id", "lower_bound": 0, "upper_bound": 100, "num_partitions": 8})
    assert options["url"] == "jdbc:postgresql://db:5433/shop" and options["user"] == "ann"
    assert options["password"] == "p@ss" and options["sslmode"] == "require"
    assert options["numPartitions"] == "8" and options["dbtable"].endswith(") AS source")
    assert connection_options("host=h dbname=d user=u")["url"] == "jdbc:postgresql://h:5432/d"
    assert connection_options("jdbc:sqlite:x") == {"url": "jdbc:sqlite:x"}
    for bad in ({}, {"dsn": "x"}, {"dsn": "host=h", "query": "q"},
                {"dsn": "dbname=d", "query": "q", "partition_column": "id"}):
        with pytest.raises(ExtractError):
            reader_options(bad)


def test_bind_values():
    assert bind("a = %s AND b = %s AND c LIKE '5%%'", [1, "o'x"]) == "a = 1 AND b = 'o''x' AND c LIKE '5%'"
    assert bind("%(d)s %(n)s %(t)s %(f)s", {"d": date(2024, 1, 1), "n": None, "t": True, "f": 1.5}) == "DATE '2024-01-01' NULL TRUE 1.5"
    assert bind("t > %s", [datetime(2024, 1, 1, 2)]) == "t > TIMESTAMP '2024-01-01 02:00:00'"
    for query, params in (("%s %s", [1]), ("%(x)s", {"y": 1}), ("%s", [object()])):
        with pytest.raises(ExtractError):
            bind(query, params)


def test_object_source(spark, tmp_path):
    config = {"bucket": "b", "key": "/k/a.csv", "endpoint_url": "http://minio:9000", "aws_access_key_id": "i", "aws_secret_access_key": "s"}
    assert object_uri(config) == "s3a://b/k/a.csv"
    assert object_options(config) == {
        "fs.s3a.endpoint": "http://minio:9000", "fs.s3a.access.key": "i", "fs.s3a.secret.key": "s", "fs.s3a.path.style.access": "true"}
    with pytest.raises(ExtractError):
        extract(spark, "s3", {"bucket": "b"})
    # the same reader over a store Spark can reach here
    put(tmp_path, "a.csv", "customer_id,email\n1,a\n2,b\n")
    assert extract(spark, "s3", {"bucket": str(tmp_path), "key": "a.csv", "scheme": "file"}).count() == 2


# layers

def test_layer_round_trip_and_drift(spark, lake):
    """D33: a column that only later runs have is NULL before."""
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert layers.read_layer(spark, lake, "bronze", "d") is None
    assert layers.preview(None) == []
    layers.write_layer(df, lake, "bronze", "d", "r1", date(2024, 1, 1))
    layers.write_layer(df.withColumn("c", F.lit(5)), lake, "bronze", "d", "r2", date(2024, 1, 2))
    layers.write_layer(df, lake, "bronze", "d", "r1", date(2024, 1, 1))
    got = layers.preview(layers.read_layer(spark, lake, "bronze", "d").orderBy("run_id"))
    assert [(r["a"], r["b"], r["c"], r["dt"], r["run_id"]) for r in got] == [
        (1, "x", None, date(2024, 1, 1), "r1"), (1, "x", 5, date(2024, 1, 2), "r2")]
    assert len(layers.preview(layers.read_layer(spark, lake, "bronze", "d"), 1)) == 1
    known = layers.read_layer(spark, lake, "bronze", "d", "a int, b string, dt date, run_id string")
    assert "c" not in known.columns and known.count() == 2


def test_layer_reads_prune_days(spark, lake):
    for day in (1, 2, 3):
        layers.write_layer(spark.range(5), lake, "bronze", "d", f"r{day}", date(2024, 1, day))
    df = layers.read_layer(spark, lake, "bronze", "d").filter("dt = DATE'2024-01-02'")
    assert df.count() == 5 and len(df.inputFiles()) <= 5 * 3
    assert "PartitionFilters: [isnotnull(dt" in df._jdf.queryExecution().executedPlan().toString()


def test_unknown_target():
    with pytest.raises(LoadError, match="nowhere"):
        targets.get_target("nowhere")


# streams

def test_poll_hands_over_each_file_once(spark, tmp_path):
    root, schema = str(tmp_path), spark.range(1).schema
    seen = []

    def sink(batch, number):
        seen.append(sorted(r.id for r in batch.collect()))

    spark.range(3).coalesce(1).write.parquet(f"{root}/in/a")
    poll_files(spark, "parquet", schema, f"{root}/in/*", f"{root}/cp", sink)
    poll_files(spark, "parquet", schema, f"{root}/in/*", f"{root}/cp", sink)
    spark.range(3, 5).coalesce(1).write.parquet(f"{root}/in/b")
    poll_files(spark, "parquet", schema, f"{root}/in/*", f"{root}/cp", sink)
    assert [s for s in seen if s] == [[0, 1, 2], [3, 4]]


def test_streamed_baseline_equals_all_rows(spark, tmp_path):
    root = str(tmp_path)
    for i, numbers in enumerate(([98.0, 100.0, 102.0], [99.0, 101.0], [500.0])):
        spark.createDataFrame([(x,) for x in numbers], "v double").coalesce(1).write.parquet(f"{root}/in/{i}")
        schema = spark.read.parquet(f"{root}/in/{i}").schema
        state = stream_baseline(spark, "parquet", schema, f"{root}/in/*", f"{root}/cp", f"{root}/state", "d").first()
    assert state["count"] == 6 and state.is_anomaly
    assert state["mean"] == pytest.approx(1000 / 6) and state.baseline_mean == pytest.approx(100)


def test_stream_rate_equals_batch_rate(spark, tmp_path):
    root = str(tmp_path)
    times = [(datetime(2024, 1, 1, 0, m, s), "A" if m % 2 else "B") for m in range(30) for s in (5, 40)]
    df = spark.createDataFrame([*times, (datetime(2024, 1, 2), "A")], "ts timestamp, status string")
    df.coalesce(1).write.parquet(f"{root}/in/a")
    stream = stream_rate(spark.readStream.schema(df.schema).parquet(f"{root}/in/*"), "ts", ["status"])
    query = stream.writeStream.format("memory").queryName("rates").outputMode("append").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    streamed = {tuple(r) for r in spark.table("rates").collect()}
    batch = ledger.event_rate(df, "ts", ["status"]).select("status", "window_end", "rate_per_second")
    whole = {tuple(r) for r in batch.collect() if r.window_end < datetime(2024, 1, 1, 12)}
    assert streamed == whole and len(whole) > 30


# ledger

def test_state_survives_and_latest_wins(spark, lake):
    state = State(spark, lake)
    assert state.watermark("p") is None and state.runs().count() == 0
    for i, status in enumerate(("RUNNING", "SUCCEEDED")):
        state.append("run_events", [{"run_id": "r", "pipeline": "p", "status": status, "seq": i, "metrics": {"rows": 1.0},
                                     "event_ts": datetime(2024, 1, 1, i), "logs": ["x"]}])
    run = state.runs().first()
    assert run.status == "SUCCEEDED" and run.metrics == {"rows": 1.0} and run.event_ts == datetime(2024, 1, 1, 1)
    state.append("watermarks", [{"pipeline": "p", "value": "1", "recorded_at": datetime(2024, 1, 1)}])
    state.append("watermarks", [{"pipeline": "p", "value": "2", "recorded_at": datetime(2024, 1, 2)}])
    assert state.watermark("p").value == "2"


def runs(spark):
    return spark.createDataFrame(
        [("r1", "p", "SUCCEEDED", 2.0, 1), ("r2", "p", "FAILED", 9.0, 2), ("r3", "q", "RETRYING", None, 3), ("r4", "q", "PENDING", None, 4)],
        "run_id string, pipeline string, status string, spent double, at int")


def test_dashboard(spark):
    d = ledger.run_dashboard(runs(spark).limit(2), F.col("spent")).first()
    assert (d.total_runs, d.succeeded, d.failed, d.success_rate_percent, d.avg_duration_seconds) == (2, 1, 1, 50.0, 2.0)
    none = ledger.run_dashboard(runs(spark).limit(0), F.col("spent")).first()
    assert none.total_runs == 0 and none.success_rate_percent is None and none.avg_duration_seconds is None
    assert [r.run_id for r in ledger.latest_failed(runs(spark), [F.desc("at")]).collect()] == ["r2"]
    assert {r.run_id for r in ledger.runs_in_flight(runs(spark)).collect()} == {"r3", "r4"}


def test_dead_letters(spark):
    dead = spark.createDataFrame([("r2", "boom")], "run_id string, error string")
    flags = {r.run_id: r.has_dead_letter for r in ledger.with_dead_letter_flag(runs(spark), dead).collect()}
    assert flags == {"r1": False, "r2": True, "r3": False, "r4": False}
    names = spark.createDataFrame([("p", "Daily")], "pipeline string, name string")
    assert ledger.dead_letter_report(dead, runs(spark), names).first().name == "Daily"


@pytest.mark.parametrize("hot_key_rows", [10**6, 1])
def test_score_trend(spark, hot_key_rows):
    cards = spark.createDataFrame([("p", 1, 88.89), ("p", 2, 100.0), ("q", 1, 50.0)], "pipeline string, at int, overall_score double")
    got = ledger.score_trend(cards, "pipeline", ["at"], hot_key_rows=hot_key_rows).orderBy("pipeline", "at")
    assert [r.score_delta for r in got.collect()] == [None, 11.11, None]


def test_histogram_quantiles(spark):
    df = spark.createDataFrame([(x,) for x in (0.001, 0.3, 0.3, 0.6, 40.0)], "d double")
    q = ledger.duration_quantiles(df, [], F.col("d"), (0.2, 0.5, 0.95)).first()
    assert q.p20 == pytest.approx(0.005) and q.p50 == pytest.approx(0.25 + 0.25 * 0.75) and q.p95 == 10.0
    assert ledger.duration_quantiles(df.limit(0), [], F.col("d")).first().p50 is None


# lineage

def test_lineage(spark):
    pipes = spark.createDataFrame(
        [("p", "crm", "customers", [("a", "b")]), ("p", "crm", "customers", [("a", "b")]), ("q", "customers", "orders", None)],
        "pipeline string, source string, dataset string, renames array<struct<from:string,to:string>>")
    edges = lineage_edges(pipes)
    assert edges.count() == 6 and lineage_nodes(edges).count() == 8
    graph = lineage_graph(edges, "customers")
    assert [n["layer"] for n in graph["nodes"]] == ["SOURCE", "BRONZE", "SILVER", "GOLD"]
    assert [e["column_mapping"] for e in graph["edges"]] == [[], [{"from": "a", "to": "b"}], []]
    # a source that happens to be called like a dataset is not part of that dataset
    assert edges_of_dataset(edges).filter("dataset = 'customers'").count() == 3


# serving

def test_serving(spark):
    df = spark.createDataFrame([(i, f"c{i % 3}", f"user{i}@x.com") for i in range(60)], "id int, country string, email string")
    assert matching(df, country="c1").count() == 20
    assert [r.id for r in page(df, [F.desc("id")], 3).collect()] == list(range(9, -1, -1))
    assert [r.id for r in page_after(df, ["country", "id"], ("c0", 54), 3).collect()] == [57, 1, 4]
    assert page_after(df, ["id"], None, 2).count() == 2
    members = spark.createDataFrame([("ann", "c1"), ("ann", "c1"), ("bob", "c2")], "member string, scope string")
    assert visible_to(df, members, "ann", "country").count() == 20
    assert masked(df).first().email == "u***@x.com" and masked(df, role="ENGINEER").first().email == "user0@x.com"


def test_hot_scope_is_split(spark, monkeypatch):
    """A scope with a third of all rows does not end up in one task when the join has to shuffle."""
    monkeypatch.setattr("millrace.operators.serve.broadcast_if_small", lambda keys: keys)
    df = spark.range(0, 30000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS scope", "sha2(cast(id AS string), 256) AS text")
    members = spark.range(-1, 30000).selectExpr("'ann' AS member", "id AS scope")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = visible_to(df, members, "ann", "scope").agg(F.count("text").alias("n"))
        assert out.collect()[0].n == 30000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
