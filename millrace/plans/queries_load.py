"""Registered queries: dimension loads, layers, snapshots, whole runs, streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.lake import layers, targets
from millrace.lake.skipping import IndexedLayer, index_run
from millrace.operators.dimension import (
    DimensionSpec, current_rows, merge_counts, merge_type2, untouched_rows, upsert_counts,
    upsert_type1, version_chain,
)
from millrace.operators.quarantine import BROKEN, DIGEST, ORIGIN
from millrace.operators.sequence import pieces_needed
from millrace.plans import replay
from millrace.plans.ingest import PipelineSpec, run_ingest
from millrace.plans.inputs import DIRTY_CUSTOMER_SQL, dirty_customer, table
from millrace.session import local_frame, scratch_path
from millrace.streaming.admission import admit_once
from millrace.streaming.baseline import stream_baseline
from millrace.streaming.keyed import collect_baselines, keyed_baselines
from millrace.streaming.poll import poll_files
from millrace.streaming.rates import collect_rates, stream_rate

QUERIES = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function

    return keep


# A buyer dimension: all customers are known already, every order is a new observation; the orders of
# every seventh customer name a key that nobody knows yet.
BUYERS = DimensionSpec(
    key="external_id", source_key="o_custkey", tracked=("status", "priority"), carried=("since",),
    required=("status",), types={"since": "date"}, defaults={}, column_order=(),
)
ORDER = ["o_orderdate", "o_orderkey"]
NOW = datetime(2002, 1, 1)
KNOWN_SINCE = datetime(1990, 1, 1)
PLAIN = ["external_id", "status", "priority", "since", "valid_from", "valid_to", "is_current"]


def known_buyers(spark, folder):
    return table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("external_id"),
        F.lit("N").alias("status"), F.col("c_mktsegment").alias("priority"),
        F.lit(None).cast("date").alias("since"),
        F.lit(str(KNOWN_SINCE)).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"), F.lit(True).alias("is_current"),
    )


def order_batch(spark, folder):
    return table(spark, folder, "orders").select(
        F.expr("CASE WHEN o_custkey % 7 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END").alias("o_custkey"),
        F.col("o_orderstatus").alias("status"),
        F.expr("CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END").alias("priority"),
        F.col("o_orderdate").cast("date").alias("since"), *ORDER,
    )


def comparable(df):
    """Validity as zone-less timestamps, which read the same in every client."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")})


BATCH_SQL = """known AS (SELECT CAST(c_custkey AS VARCHAR) AS external_id, 'N' AS status, c_mktsegment AS priority,
        CAST(NULL AS DATE) AS since FROM customer),
    batch AS (SELECT CAST(CASE WHEN o_custkey % 7 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS VARCHAR) AS external_id, o_orderstatus AS status,
        CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority,
        CAST(o_orderdate AS DATE) AS since, o_orderdate, o_orderkey FROM orders)"""
TYPE1_SQL = f"""WITH {BATCH_SQL},
    latest AS (SELECT * FROM batch QUALIFY row_number() OVER
        (PARTITION BY external_id ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    merged AS (SELECT external_id, l.status, l.priority, l.since, k.external_id IS NOT NULL AS old
        FROM latest l LEFT JOIN known k USING (external_id)
        UNION ALL SELECT external_id, status, priority, since, true FROM known
        WHERE external_id NOT IN (SELECT external_id FROM latest))
    SELECT external_id, status, priority, since,
        CASE WHEN old THEN TIMESTAMP '1990-01-01' ELSE TIMESTAMP '2002-01-01' END AS valid_from,
        CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current FROM merged"""


@query("upsert_type1", TYPE1_SQL)
def type1(spark, folder):
    return comparable(
        upsert_type1(known_buyers(spark, folder), order_batch(spark, folder), BUYERS, ORDER, NOW)
    )


@query(
    "upsert_type1_counts",
    f"""WITH {BATCH_SQL}, fresh AS (SELECT count(DISTINCT external_id) AS n FROM batch
        WHERE external_id NOT IN (SELECT external_id FROM known))
    SELECT n AS created, (SELECT count(*) FROM batch) - n AS updated FROM fresh""",
)
def type1_counts(spark, folder):
    return upsert_counts(known_buyers(spark, folder), order_batch(spark, folder), BUYERS)


@query("upsert_idempotent", TYPE1_SQL)
def type1_twice(spark, folder):
    """The same batch loaded twice gives the table of one load."""
    batch = order_batch(spark, folder)
    once = upsert_type1(known_buyers(spark, folder), batch, BUYERS, ORDER, NOW)
    return comparable(upsert_type1(once, batch, BUYERS, ORDER, datetime(2003, 1, 1)))


@query("upsert_ordered_by_attribute", TYPE1_SQL)
def type1_by_attribute(spark, folder):
    """The rows' order may be told by an attribute of the dimension."""
    order = ["since", "o_orderkey"]
    return comparable(upsert_type1(known_buyers(spark, folder), order_batch(spark, folder), BUYERS, order, NOW))


CHAIN_SQL = """SELECT external_id, status, priority, first_since AS since, valid_from,
        lead(valid_from) OVER w AS valid_to, lead(step) OVER w IS NULL AS is_current, rn = 1 AS opens_key, step
    FROM (SELECT *, lag(status) OVER w AS s0, lag(priority) OVER w AS p0, row_number() OVER w AS rn,
            first_value(since) OVER w AS first_since FROM observed
          WINDOW w AS (PARTITION BY external_id ORDER BY step, o_orderdate, o_orderkey))
    WHERE rn = 1 OR status IS DISTINCT FROM s0 OR priority IS DISTINCT FROM p0
    WINDOW w AS (PARTITION BY external_id ORDER BY step, o_orderdate, o_orderkey)"""


@query(
    "scd2_history",
    f"""WITH {BATCH_SQL}, observed AS (SELECT *, 1 AS step, o_orderdate AS valid_from FROM batch),
    chain AS ({CHAIN_SQL})
    SELECT external_id, status, priority, since, valid_from, valid_to, is_current FROM chain""",
)
def order_history(spark, folder):
    """Versions with real validity, from all orders of a buyer."""
    rows = order_batch(spark, folder).withColumns(
        {"external_id": F.col("o_custkey").cast("string"), "valid_from": F.col("o_orderdate").cast("timestamp")}
    )
    pieces = pieces_needed(rows, ["external_id"])
    chain = version_chain(
        rows, ["external_id"], list(BUYERS.tracked), list(BUYERS.carried), ORDER, pieces=pieces
    )
    return comparable(chain.select(*PLAIN))


MERGE_SQL = f"""{BATCH_SQL},
    observed AS (SELECT external_id, status, priority, since, CAST(NULL AS TIMESTAMP) AS o_orderdate,
            CAST(NULL AS BIGINT) AS o_orderkey, 0 AS step, TIMESTAMP '1990-01-01' AS valid_from
        FROM known WHERE external_id IN (SELECT external_id FROM batch)
        UNION ALL SELECT *, 1, TIMESTAMP '2002-01-01' FROM batch),
    chain AS ({CHAIN_SQL})"""


@query(
    "scd2_merge",
    f"""WITH {MERGE_SQL}
    SELECT external_id, status, priority, since, valid_from, valid_to, is_current FROM chain
    UNION ALL SELECT external_id, status, priority, since, TIMESTAMP '1990-01-01', NULL, true FROM known
        WHERE external_id NOT IN (SELECT external_id FROM batch)""",
)
def type2(spark, folder):
    """One load with many rows per key: versions of zero length stay, as rows arrive in order."""
    known, batch = known_buyers(spark, folder), order_batch(spark, folder)
    versions = merge_type2(known, batch, BUYERS, ORDER, NOW)
    whole = versions.select(*PLAIN).unionByName(untouched_rows(known, batch, BUYERS).select(*PLAIN))
    return comparable(whole)


@query(
    "scd2_counts",
    f"""WITH {MERGE_SQL} SELECT count(*) FILTER (opens_key AND step = 1) AS created,
        count(*) FILTER (NOT opens_key) AS updated FROM chain""",
)
def type2_counts(spark, folder):
    return merge_counts(merge_type2(known_buyers(spark, folder), order_batch(spark, folder), BUYERS, ORDER, NOW))


@query(
    "current_rows_snapshot",
    f"""WITH {MERGE_SQL}
    SELECT external_id, status, priority, since, valid_from, valid_to, is_current FROM chain WHERE is_current
    UNION ALL SELECT external_id, status, priority, since, TIMESTAMP '1990-01-01', NULL, true FROM known
        WHERE external_id NOT IN (SELECT external_id FROM batch)""",
)
def stored_current_rows(spark, folder):
    """The same load through a stored dimension, read back as current rows of its history."""
    dim = targets.Dimension(spark, scratch_path(spark, "dimension"), BUYERS)
    dim.write(0, known_buyers(spark, folder).select(*BUYERS.columns), run_id="seed")
    targets.load_type2(dim, order_batch(spark, folder), ORDER, NOW)
    return comparable(current_rows(dim.history(), BUYERS).select(*PLAIN))


@query(
    "scd2_after_dead_load",
    f"""WITH {MERGE_SQL}
    SELECT external_id, status, priority, since, valid_from, valid_to, is_current FROM chain
    UNION ALL SELECT external_id, status, priority, since, TIMESTAMP '1990-01-01', NULL, true FROM known
        WHERE external_id NOT IN (SELECT external_id FROM batch)""",
)
def history_after_dead_load(spark, folder):
    """What a load wrote that died before its commit is in no history, also after the next load."""
    dim = targets.Dimension(spark, scratch_path(spark, "dimension"), BUYERS)
    known = known_buyers(spark, folder).select(*BUYERS.columns)
    dim.write(0, known, run_id="seed")
    for part in ("closed/00000002-dead", "data/00000002-dead/key_bucket=0"):
        known.write.parquet(f"{dim.folder}/{part}")
    targets.load_type2(dim, order_batch(spark, folder), ORDER, NOW, "alive")
    return comparable(dim.history().select(*PLAIN))


# So few rows that the given tables fill many buckets.
SMALL_BUCKETS = 100


@query(
    "scd2_by_buckets",
    f"""WITH {MERGE_SQL}
    SELECT external_id, status, priority, since, valid_from, valid_to, is_current FROM chain
    UNION ALL SELECT external_id, status, priority, since, TIMESTAMP '1990-01-01', NULL, true FROM known
        WHERE external_id NOT IN (SELECT external_id FROM batch)""",
)
def history_by_buckets(spark, folder):
    """A Type-2 load into a dimension of many key buckets, then one that changes nothing and writes no bucket."""
    dim = targets.Dimension(spark, scratch_path(spark, "dimension"), BUYERS, bucket_rows=SMALL_BUCKETS)
    dim.write(0, known_buyers(spark, folder).select(*BUYERS.columns), run_id="seed")
    targets.load_type2(dim, order_batch(spark, folder), ORDER, NOW, "orders")
    newest = order_batch(spark, folder).withColumn(
        "place", F.row_number().over(Window.partitionBy("o_custkey").orderBy(*[F.desc(c) for c in ORDER]))
    ).filter("place = 1")
    targets.load_type2(dim, newest, ORDER, datetime(2003, 1, 1), "again")
    return comparable(dim.history().select(*PLAIN))


@query("upsert_by_buckets", TYPE1_SQL)
def type1_by_buckets(spark, folder):
    """Two Type-1 loads, one after the other, into a dimension that outgrows its buckets between them."""
    dim = targets.Dimension(spark, scratch_path(spark, "dimension"), BUYERS, bucket_rows=SMALL_BUCKETS)
    known, orders = known_buyers(spark, folder).select(*BUYERS.columns), order_batch(spark, folder)
    dim.commit(None, known, "seed", buckets=1)
    early = F.col("o_orderdate") < F.lit("1996-01-01")
    targets.load_type1(dim, orders.filter(early), ORDER, NOW, "early")
    targets.load_type1(dim, orders.filter(~early), ORDER, NOW, "late")
    return comparable(dim.current().select(*PLAIN))


@query("gold_latest_snapshot", TYPE1_SQL)
def gold_latest_snapshot(spark, folder):
    """Of two stored snapshots only the newest is read."""
    dim = targets.Dimension(spark, scratch_path(spark, "dimension"), BUYERS)
    dim.write(0, known_buyers(spark, folder).select(*BUYERS.columns), run_id="seed")
    targets.load_type1(dim, order_batch(spark, folder), ORDER, NOW)
    return comparable(dim.current().select(*PLAIN))


EVENT_COLUMNS = "event_id, ts, user_id, event_type, value"


@query("layer_write_roundtrip", f"SELECT {EVENT_COLUMNS}, props, CAST(ts AS DATE) AS dt, 'r1' AS run_id FROM events")
def layer_write_roundtrip(spark, folder):
    root = scratch_path(spark, "lake")
    events = table(spark, folder, "events")
    for _ in range(2):  # the second write replaces the first
        layers.write_layer_by_date(events, root, "bronze", "events", "r1", F.col("ts"))
    return layers.read_layer(spark, root, "bronze", "events")


def _two_runs(spark, folder):
    """Two runs of one layer; the second brings a column the first does not have."""
    root = scratch_path(spark, "lake")
    events = table(spark, folder, "events")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    layers.write_layer_by_date(events.filter(~late).drop("props"), root, "silver", "events", "r1", F.col("ts"))
    layers.write_layer_by_date(events.filter(late), root, "silver", "events", "r2", F.col("ts"))
    return layers.read_layer(spark, root, "silver", "events")


TWO_RUNS_SQL = (
    f"SELECT {EVENT_COLUMNS}, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN props END AS props,"
    " CAST(ts AS DATE) AS dt, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 'r2' ELSE 'r1' END AS run_id FROM events"
)


@query("layer_union_scan", TWO_RUNS_SQL)
def layer_union_scan(spark, folder):
    return _two_runs(spark, folder)


@query("layer_preview", f"SELECT * FROM ({TWO_RUNS_SQL}) ORDER BY ts DESC, event_id DESC LIMIT 100")
def layer_preview(spark, folder):
    """The preview operator: the newest hundred rows of a layer."""
    return _two_runs(spark, folder).orderBy(F.desc("ts"), F.desc("event_id")).limit(100)


INGEST = {
    "transform": {
        "clean": {"trim": ["name"], "lowercase": ["segment"], "fill_null": {"nation": -1}, "drop_rows_missing": ["name"]},
        "rename": {"c_custkey": "customer_id", "name": "email", "segment": "first_name"},
        "cast": {"nation": "str"},
        "drop_duplicates": ["customer_id"],
        "select": ["customer_id", "email", "first_name"],
    },
    "validation": {
        "rules": [
            {"type": "required_columns", "columns": ["c_custkey", "name"]},
            {"type": "not_null", "columns": ["name"]},
            {"type": "unique", "columns": ["c_custkey"]},
            {"type": "range", "column": "balance", "min": 0, "severity": "warning"},
        ]
    },
}


def _ingest(spark, folder):
    root = scratch_path(spark, "lake")
    landed = f"{root}/landed"
    dirty_customer(spark, folder).write.parquet(landed)
    spec = PipelineSpec(
        "customers-daily", {"type": "parquet", "path": landed}, "crm", target="customers", order_by=["customer_id"], **INGEST
    )
    return root, run_ingest(spark, root, spec, "run-1", NOW)


CLEAN_SQL = (
    "SELECT c_custkey, trim(name) AS email, name, lower(segment) AS first_name, segment, balance, nation, age"
    f" FROM ({DIRTY_CUSTOMER_SQL})"
)


@query(
    "ingest_end_to_end",
    f"SELECT CAST(c_custkey AS VARCHAR) AS external_id, first_name, '' AS last_name, email, '' AS country,"
    f" true AS is_current FROM ({CLEAN_SQL}) WHERE email <> ''",
)
def ingest_end_to_end(spark, folder):
    root, _ = _ingest(spark, folder)
    gold = targets.open_dimension(spark, root, "customers").current()
    return gold.select("external_id", "first_name", "last_name", "email", "country", "is_current")


@query(
    "ingest_metrics",
    f"""WITH c AS ({CLEAN_SQL}), k AS (SELECT * FROM c WHERE email <> ''),
    m AS (SELECT count(*) AS n, count(*) FILTER (balance < 0) AS bad,
        2 * count(*) - count(balance) - count(age) AS nulls FROM k)
    SELECT (SELECT count(*) FROM c) AS rows_extracted, n AS rows_loaded, n AS created, CAST(0 AS BIGINT) AS updated,
        (SELECT count(*) FROM c WHERE email <> name) AS cells_trimmed,
        (SELECT count(*) FROM c WHERE segment <> first_name) AS cells_lowercased,
        (SELECT count(*) FROM c WHERE nation IS NULL) AS cells_filled,
        (SELECT count(*) FROM c WHERE coalesce(email, '') = '') AS rows_dropped,
        round(100.0 * (1 - nulls / (6.0 * n)), 1) AS completeness, CAST(100 AS DOUBLE) AS consistency,
        round(100.0 * (1 - bad / CAST(n AS DOUBLE)), 1) AS accuracy FROM m""",
)
def ingest_metrics(spark, folder):
    _, r = _ingest(spark, folder)
    row = {
        "rows_extracted": r.rows_extracted, "rows_loaded": r.rows_loaded, **r.load_result, **r.clean_stats,
        **{k: getattr(r.validation, k) for k in ("completeness", "consistency", "accuracy")},
    }
    names = ", ".join(f"{k} {'double' if isinstance(v, float) else 'bigint'}" for k, v in row.items())
    scores = ("completeness", "consistency", "accuracy")
    return local_frame(spark, [row], names).withColumns({c: F.round(c, 1) for c in scores})


@query(
    "restart_metrics",
    f"""SELECT count(*) AS rows_loaded, count(*) AS created, CAST(0 AS BIGINT) AS updated
        FROM ({CLEAN_SQL}) WHERE email <> ''""",
)
def restart_metrics(spark, folder):
    """A run that is started again after its load reports what that load did."""
    root, first = _ingest(spark, folder)
    spec = PipelineSpec(
        "customers-daily", {"type": "parquet", "path": f"{root}/landed"}, "crm", target="customers",
        order_by=["customer_id"], **INGEST,
    )
    again = run_ingest(spark, root, spec, first.run_id, NOW)
    row = {"rows_loaded": again.rows_loaded, **again.load_result}
    return local_frame(spark, [row], "rows_loaded bigint, created bigint, updated bigint")


SINCE = "2024-01-20 06:30:00"


@query(
    "incremental_layer_skips_files",
    f"""SELECT {EVENT_COLUMNS}, CAST(ts AS DATE) AS dt, 'r1' AS run_id FROM events
        WHERE ts > TIMESTAMP '{SINCE}' - INTERVAL 1 HOUR""",
)
def incremental_layer(spark, folder):
    """Rows past a watermark, less an hour of grace, from a layer whose index names the files that have any."""
    root = scratch_path(spark, "lake")
    events = table(spark, folder, "events").drop("props")
    layers.write_layer_by_date(events, root, "bronze", "events", "r1", F.col("ts"))
    index_run(spark, root, "bronze", "events", "r1")
    return IndexedLayer(spark, root, "bronze", "events").newer("ts", SINCE, 3600)


SET_ASIDE = {
    "transform": {**INGEST["transform"], "clean": {"trim": ["name"], "lowercase": ["segment"], "fill_null": {"nation": -1}}},
    "validation": {"rules": [
        {"type": "not_null", "columns": ["name"]},
        {"type": "range", "column": "balance", "min": 0},
        {"type": "business_rule", "name": "grown", "expression": "cast(age AS int) >= 18", "severity": "blocking"},
        {"type": "unique", "columns": ["c_custkey"]},
        {"type": "allowed_values", "column": "segment", "values": ["building"], "severity": "warning"},
    ]},
}
BROKEN_SQL = """concat_ws(',', CASE WHEN email IS NULL OR email = '' THEN 'not_null' END, CASE WHEN balance < 0 THEN 'range' END,
    CASE WHEN coalesce(TRY_CAST(age AS INTEGER) < 18, true) THEN 'grown' END)"""


@query(
    "quarantine_replay",
    f"""WITH c AS (SELECT c_custkey, nullif(email, '') AS email, first_name, {BROKEN_SQL} AS broken FROM ({CLEAN_SQL})),
    f AS (SELECT *, CASE WHEN c_custkey % 2 = 0 THEN 'fixed ' || c_custkey END AS fixed FROM c)
    SELECT CAST(c_custkey AS VARCHAR) AS external_id, first_name,
        CASE WHEN broken <> '' THEN coalesce(fixed, email) ELSE email END AS email,
        CASE WHEN broken = '' THEN 'loaded' WHEN c_custkey % 3 = 0 THEN 'pending' WHEN c_custkey % 2 = 0 THEN 'replayed'
            ELSE 'set aside again' END AS state,
        CASE WHEN broken = '' OR (c_custkey % 3 <> 0 AND c_custkey % 2 = 0) THEN ''
            WHEN c_custkey % 3 = 0 THEN broken ELSE concat_ws(',', CASE WHEN email IS NULL THEN 'not_null' END, 'range') END AS broken
    FROM (SELECT f.* REPLACE (CASE WHEN c_custkey % 3 = 0 AND broken <> '' THEN NULL ELSE fixed END AS fixed) FROM f)""",
)
def quarantine_replay(spark, folder):
    """Rows that break rules are set aside; corrections for two thirds of them are replayed, of which half
    still break a rule."""
    root = scratch_path(spark, "lake")
    landed = f"{root}/landed"
    dirty_customer(spark, folder).write.parquet(landed)
    spec = PipelineSpec(
        "customers-daily", {"type": "parquet", "path": landed}, "crm", target="customers", order_by=["customer_id"],
        quarantine=True, **SET_ASIDE,
    )
    run_ingest(spark, root, spec, "run-1", NOW)
    even = F.col("c_custkey") % 2 == 0
    corrections = replay.pending(spark, root, "customers").filter("c_custkey % 3 <> 0").select(
        DIGEST, F.when(even, F.concat(F.lit("fixed "), "c_custkey")).otherwise(F.col("name")).alias("name"),
        F.when(even, F.lit(1.0)).otherwise(F.lit(-1.0)).alias("balance"), F.lit("44").alias("age"),
    )
    replay.replay(spark, root, spec, corrections, "run-2", datetime(2003, 1, 1))
    gold = targets.open_dimension(spark, root, "customers").current().select(
        "external_id", "first_name", "email",
        F.when(F.col("valid_from") == F.lit(str(NOW)).cast("timestamp"), "loaded").otherwise("replayed").alias("state"),
        F.lit("").alias("broken"),
    )
    left = replay.pending(spark, root, "customers").select(
        F.col("c_custkey").cast("string").alias("external_id"), F.col("segment").alias("first_name"), F.col("name").alias("email"),
        F.when(F.col(ORIGIN) == "run-1", "pending").otherwise("set aside again").alias("state"),
        F.array_join(BROKEN, ",").alias("broken"),
    )
    return gold.unionByName(left)


@query("poll_new_files", f"SELECT {EVENT_COLUMNS}, props FROM events")
def poll_new_files(spark, folder):
    """Two polls of the same folder: the second finds nothing new, so every row arrives once."""
    root = scratch_path(spark, "poll")
    schema = table(spark, folder, "events").schema

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for _ in range(2):
        poll_files(spark, "parquet", schema, f"{folder}/event[s].parquet", f"{root}/checkpoint", sink)
    return spark.read.schema(schema).parquet(f"{root}/out/*")


MEASURES = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def _digits_sql(value: str, name: str) -> str:
    """A positive number by its first four digits and its magnitude."""
    return f"CAST(round({value} / pow(10, floor(log10({value})) - 3)) AS BIGINT) AS {name}, CAST(floor(log10({value})) AS BIGINT) AS {name}_power"


def _digits(value, name: str) -> list:
    power = F.floor(F.log10(value))
    return [F.round(value / F.pow(F.lit(10.0), power - 3)).cast("bigint").alias(name), power.cast("bigint").alias(f"{name}_power")]


BASELINES_SQL = " UNION ALL ".join(
    f"SELECT 'lineitem' AS dataset, '{c}' AS \"column\", count(*) AS count, {_digits_sql(f'avg({c})', 'mean')},"
    f" {_digits_sql(f'stddev_pop({c})', 'stddev')} FROM lineitem"
    for c in MEASURES
)


@query("stream_baseline", BASELINES_SQL)
def streamed_baseline(spark, folder):
    """The running baseline after all micro-batches equals the moments of all rows."""
    root = scratch_path(spark, "stream")
    # Two landed files, so that there are two micro-batches to merge.
    lines = table(spark, folder, "lineitem").select("l_returnflag", *MEASURES)
    for name, part in (("a", lines.filter("l_returnflag = 'R'")), ("b", lines.filter("l_returnflag <> 'R'"))):
        part.drop("l_returnflag").write.parquet(f"{root}/landed/{name}")
    schema = lines.drop("l_returnflag").schema
    state = stream_baseline(
        spark, "parquet", schema, f"{root}/landed/*", f"{root}/checkpoint", f"{root}/state", "lineitem"
    )
    spread = F.sqrt(F.col("m2") / F.col("count"))
    return state.select("dataset", "column", "count", *_digits(F.col("mean"), "mean"), *_digits(spread, "stddev"))


@query(
    "stream_keyed_baseline",
    " UNION ALL ".join(
        f"SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag || l_linestatus END AS dataset, '{c}' AS \"column\", count(*) AS count,"
        f" {_digits_sql(f'avg({c})', 'mean')}, {_digits_sql(f'stddev_pop({c})', 'stddev')} FROM lineitem GROUP BY 1"
        for c in MEASURES
    ),
)
def streamed_keyed_baseline(spark, folder):
    """One state per dataset and column, from eight files in two triggers; a third of the rows are of one dataset."""
    root = scratch_path(spark, "stream")
    lines = table(spark, folder, "lineitem").select(
        F.expr("CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE l_returnflag || l_linestatus END").alias("dataset"), *MEASURES
    )
    for half in range(2):
        part = lines.filter(F.col("l_linenumber") % 2 == half)
        part.repartition(4, "l_orderkey").write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(lines.schema).parquet(f"{root}/landed")
        state = collect_baselines(keyed_baselines(stream, "dataset"), f"{root}/checkpoint", f"{root}/told")
    spread = F.sqrt(F.col("m2") / F.col("count"))
    return state.select("dataset", "column", "count", *_digits(F.col("mean"), "mean"), *_digits(spread, "stddev"))


@query("stream_admitted_once", f"SELECT {EVENT_COLUMNS} FROM events")
def streamed_admission(spark, folder):
    """Files that come late or twice: the table is that of one clean pass."""
    root = scratch_path(spark, "admission")
    events = table(spark, folder, "events").drop("props").withColumn("ts", F.col("ts").cast("timestamp"))
    parts = [events.filter(F.floor(F.dayofmonth("ts") / 8) == i) for i in range(4)]
    # The second week comes after the third, and the first one again at the end.
    for i in (0, 2, 1, 3, 0):
        parts[i].coalesce(1).write.mode("append").parquet(f"{root}/landed")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/landed")
        admitted = admit_once(stream, ["event_id"], "ts", "1 hour", f"{root}/checkpoint", f"{root}/table")
    return admitted.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_rate_5m",
    "SELECT event_type, window_end, round(CAST(sum(n) AS DOUBLE) / 300, 6) AS rate_per_second FROM ("
    "SELECT event_type, minute + to_minutes(CAST(i AS BIGINT)) AS window_end, n FROM ("
    "SELECT event_type, date_trunc('minute', ts) AS minute, count(*) AS n FROM events GROUP BY 1, 2),"
    " range(1, 6) t(i)) GROUP BY 1, 2",
)
def streamed_rate(spark, folder):
    """Sliding rates of a stream, those of windows that may still change included: each micro-batch gives
    the windows it changed, and of a window the newest value counts."""
    root = scratch_path(spark, "rates")
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{folder}/event[s].parquet").select(
        F.col("ts").cast("timestamp").alias("ts"), "event_type"
    )
    rates = stream_rate(events, "ts", ["event_type"]).select(
        "event_type", F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        F.round("rate_per_second", 6).alias("rate_per_second"),
    )
    return collect_rates(rates, ["event_type", "window_end"], f"{root}/checkpoint", f"{root}/out")
