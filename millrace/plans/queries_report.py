"""Registered queries: catalog, lineage, ledger analytics, serving."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import ledger
from millrace.operators.asof import asof_join
from millrace.operators.drift import column_catalog, latest_version, schema_drift, schema_profile
from millrace.operators.lineage import edges_of_dataset, layer_rank, lineage_edges, lineage_nodes
from millrace.operators.relations import Model
from millrace.operators.serve import matching, page, page_after, visible_to
from millrace.plans.inputs import RUN_EVENTS_SQL, RUNS_SQL, run_events, table

QUERIES = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function

    return keep


# --- schema history: a user is a dataset, a day is a run, the day's event types are its columns ---

OBSERVED_SQL = (
    "SELECT user_id AS dataset, CAST(ts AS DATE) AS run, event_type AS name,"
    " CASE WHEN max(value) > 20 THEN 'double' ELSE 'bigint' END AS dtype FROM events GROUP BY 1, 2, 3"
)
RENAMES = {"click": "view", "signup": "purchase"}
DRIFT_SQL = f"""WITH r AS (SELECT dataset, run, list_sort(list(DISTINCT name)) AS names FROM ({OBSERVED_SQL}) GROUP BY 1, 2),
    c AS (SELECT *, lag(names) OVER (PARTITION BY dataset ORDER BY run) AS was FROM r
        QUALIFY was IS NULL OR was <> names),
    d AS (SELECT dataset, run, names, was IS NOT NULL AS is_drift,
        row_number() OVER (PARTITION BY dataset ORDER BY run) AS version,
        list_filter(names, lambda x: NOT list_contains(coalesce(was, names), x)) AS gained,
        list_filter(coalesce(was, names), lambda x: NOT list_contains(names, x)) AS lost FROM c),
    e AS (SELECT *, list_contains(lost, 'click') AND list_contains(gained, 'view') AS r1,
        list_contains(lost, 'signup') AND list_contains(gained, 'purchase') AS r2 FROM d)
    SELECT dataset, run, CAST(version AS INTEGER) AS version, array_to_string(names, ',') AS names,
        array_to_string(list_filter(gained, lambda x: NOT ((r1 AND x = 'view') OR (r2 AND x = 'purchase'))), ',') AS added,
        array_to_string(list_filter(lost, lambda x: NOT ((r1 AND x = 'click') OR (r2 AND x = 'signup'))), ',') AS removed,
        CASE WHEN r1 AND r2 THEN 'click>view,signup>purchase' WHEN r1 THEN 'click>view'
            WHEN r2 THEN 'signup>purchase' ELSE '' END AS renamed, is_drift FROM e"""


def _observed(spark, folder):
    return table(spark, folder, "events").groupBy(
        F.col("user_id").alias("dataset"), F.col("ts").cast("date").alias("run"), F.col("event_type").alias("name")
    ).agg(F.when(F.max("value") > 20, "double").otherwise("bigint").alias("dtype"))


def _versions(spark, folder):
    # A dataset has one row per day here, so no key can grow beyond a task.
    found = schema_drift(
        _observed(spark, folder), ["dataset"], "run", "name", RENAMES, hot_key_rows=None
    )
    pairs = F.transform("renamed", lambda r: F.concat(r["from"], F.lit(">"), r["to"]))
    return found.select(
        "dataset", "run", "version", *[F.array_join(c, ",").alias(c) for c in ("names", "added", "removed")],
        F.array_join(pairs, ",").alias("renamed"), "is_drift",
    )


@query("schema_drift", DRIFT_SQL)
def drift_history(spark, folder):
    return _versions(spark, folder)


@query(
    "schema_latest",
    f"SELECT dataset, run, version, names FROM ({DRIFT_SQL})"
    " QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY version DESC) = 1",
)
def schema_latest(spark, folder):
    return latest_version(_versions(spark, folder).select("dataset", "run", "version", "names"), ["dataset"])


@query(
    "column_catalog",
    f"SELECT dataset, name, arg_max(dtype, run) AS dtype, min(run) AS first_seen, max(run) AS last_seen"
    f" FROM ({OBSERVED_SQL}) GROUP BY 1, 2",
)
def catalog_columns(spark, folder):
    return column_catalog(_observed(spark, folder), ["dataset"], "run")


@query(
    "schema_profile",
    "SELECT CAST(position AS INTEGER) AS position, name, dtype, populated FROM ("
    + " UNION ALL ".join(
        f"SELECT {i} AS position, '{n}' AS name, '{t}' AS dtype, count({n}) AS populated FROM orders"
        for i, (n, t) in enumerate(
            [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
             ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]
        )
    )
    + ")",
)
def orders_profile(spark, folder):
    return schema_profile(table(spark, folder, "orders"))


# --- lineage: every document source feeds the datasets of its languages ---------------------------

PIPES_SQL = (
    "pipes AS (SELECT DISTINCT source || '-' || lang AS pipeline, source, lang AS dataset,"
    " CASE WHEN lang = 'en' THEN '' ELSE 'text>' || lang END AS mapping FROM documents)"
)
EDGES_SQL = f"""WITH {PIPES_SQL}
    SELECT pipeline, 'SOURCE' AS from_layer, source AS from_name, 'BRONZE' AS to_layer, dataset AS to_name, '' AS mapping FROM pipes
    UNION ALL SELECT pipeline, 'BRONZE', dataset, 'SILVER', dataset, mapping FROM pipes
    UNION ALL SELECT pipeline, 'SILVER', dataset, 'GOLD', dataset, '' FROM pipes"""


def _edges(spark, folder):
    renames = F.when(
        F.col("lang") != "en", F.array(F.struct(F.lit("text").alias("from"), F.col("lang").alias("to")))
    )
    # Distinct before anything else: there are few (source, language) pairs, whatever the documents.
    pipes = table(spark, folder, "documents").select("source", "lang").distinct().select(
        F.concat_ws("-", "source", "lang").alias("pipeline"), "source", F.col("lang").alias("dataset"),
        renames.alias("renames"),
    )
    return lineage_edges(pipes)


def _mapping():
    return F.array_join(
        F.transform("column_mapping", lambda m: F.concat(m["from"], F.lit(">"), m["to"])), ","
    ).alias("mapping")


@query("lineage_edges", EDGES_SQL)
def edges(spark, folder):
    found = _edges(spark, folder)
    return found.select("pipeline", "from_layer", "from_name", "to_layer", "to_name", _mapping())


@query(
    "lineage_nodes",
    f"SELECT from_layer AS layer, from_name AS name FROM ({EDGES_SQL}) UNION SELECT to_layer, to_name FROM ({EDGES_SQL})",
)
def nodes(spark, folder):
    return lineage_nodes(_edges(spark, folder))


@query(
    "lineage_graph",
    f"SELECT to_name AS dataset, CAST(CASE from_layer WHEN 'SOURCE' THEN 1 WHEN 'BRONZE' THEN 2 ELSE 3 END AS BIGINT) AS rank,"
    f" pipeline, from_layer, from_name, to_layer, to_name, mapping FROM ({EDGES_SQL}) ORDER BY 1, 2, 3",
)
def graphs(spark, folder):
    """The layered graph of every dataset; an edge belongs to the dataset at either of its ends."""
    found = edges_of_dataset(_edges(spark, folder))
    return found.select(
        "dataset", layer_rank(F.col("from_layer")).alias("rank"), "pipeline", "from_layer", "from_name",
        "to_layer", "to_name", _mapping(),
    ).orderBy("dataset", "rank", "pipeline")


# --- run ledger -----------------------------------------------------------------------------------

RUN_COLUMNS = "run_id, pipeline, status, event_ts, seq, duration, metrics"


def _runs(spark, folder):
    return ledger.run_current_state(run_events(spark, folder))


@query("run_current_state", f"SELECT {RUN_COLUMNS} FROM ({RUNS_SQL})")
def run_current_state(spark, folder):
    return _runs(spark, folder)


@query(
    "run_dashboard",
    "SELECT count(*) AS total_runs, count(*) FILTER (status = 'SUCCEEDED') AS succeeded,"
    " count(*) FILTER (status = 'FAILED') AS failed, count(*) FILTER (status = 'RETRYING') AS retrying,"
    " count(*) FILTER (status IN ('PENDING', 'RUNNING')) AS pending_or_running,"
    " round(100.0 * count(*) FILTER (status = 'SUCCEEDED') / count(*), 2) AS success_rate_percent,"
    f" round(avg(CAST(metrics->>'$.k' AS DOUBLE)) FILTER (status = 'SUCCEEDED'), 4) AS avg_duration_seconds FROM ({RUNS_SQL})",
)
def dashboard(spark, folder):
    spent = F.get_json_object("metrics", "$.k").try_cast("double")
    return ledger.run_dashboard(_runs(spark, folder), spent)


@query("runs_in_flight", f"SELECT {RUN_COLUMNS} FROM ({RUNS_SQL}) WHERE status IN ('PENDING', 'RUNNING', 'RETRYING')")
def in_flight(spark, folder):
    return ledger.runs_in_flight(_runs(spark, folder)).orderBy(F.desc("event_ts"), F.desc("seq"))


@query(
    "failed_top20",
    f"SELECT run_id, c_name AS pipeline_name, metrics AS error, event_ts FROM ({RUNS_SQL})"
    " LEFT JOIN customer ON c_custkey = pipeline WHERE status = 'FAILED' ORDER BY event_ts DESC, seq DESC LIMIT 20",
)
def failed_jobs(spark, folder):
    newest = ledger.latest_failed(_runs(spark, folder), [F.desc("event_ts"), F.desc("seq")])
    names = table(spark, folder, "customer").select(F.col("c_custkey").alias("pipeline"), F.col("c_name").alias("pipeline_name"))
    named = newest.join(names, "pipeline", "left").orderBy(F.desc("event_ts"), F.desc("seq"))
    return named.select("run_id", "pipeline_name", F.col("metrics").alias("error"), "event_ts")


DEAD_SQL = f"SELECT run_id, max(duration) AS worst FROM ({RUN_EVENTS_SQL}) WHERE status = 'FAILED' AND duration > 1 GROUP BY 1"


def _dead_letters(spark, folder):
    failures = run_events(spark, folder).filter("status = 'FAILED' AND duration > 1")
    return failures.groupBy("run_id").agg(F.max("duration").alias("worst"))


@query(
    "run_dead_letter_flag",
    f"SELECT run_id, status, run_id IN (SELECT run_id FROM ({DEAD_SQL})) AS has_dead_letter FROM ({RUNS_SQL})",
)
def dead_letter_flag(spark, folder):
    flagged = ledger.with_dead_letter_flag(_runs(spark, folder), _dead_letters(spark, folder))
    return flagged.select("run_id", "status", "has_dead_letter")


@query(
    "dead_letter_report",
    f"SELECT d.run_id, round(worst, 4) AS worst, status, pipeline, c_name AS pipeline_name FROM ({DEAD_SQL}) d"
    f" LEFT JOIN ({RUNS_SQL}) r USING (run_id) LEFT JOIN customer ON c_custkey = pipeline",
)
def dead_letters(spark, folder):
    pipelines = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("pipeline"), F.col("c_name").alias("pipeline_name")
    )
    report = ledger.dead_letter_report(_dead_letters(spark, folder), _runs(spark, folder), pipelines)
    return report.select("run_id", F.round("worst", 4).alias("worst"), "status", "pipeline", "pipeline_name")


@query(
    "ledger_totals",
    "SELECT status, count(*) AS runs, CAST(sum(CAST(metrics->>'$.k' AS BIGINT)) AS BIGINT) AS rows_processed,"
    " CAST(sum(CASE WHEN status = 'RETRYING' THEN 1 ELSE 0 END) AS BIGINT) AS retries"
    f" FROM ({RUN_EVENTS_SQL}) GROUP BY status",
)
def totals(spark, folder):
    rows = F.get_json_object("metrics", "$.k").cast("bigint")
    retries = F.when(F.col("status") == ledger.RETRYING, 1).otherwise(0)
    return ledger.ledger_totals(run_events(spark, folder), rows, retries)


@query(
    "rate_5m",
    "SELECT status, window_end, round(CAST(sum(n) AS DOUBLE) / 300, 6) AS rate_per_second FROM ("
    "SELECT status, minute + to_minutes(CAST(i AS BIGINT)) AS window_end, n FROM ("
    f"SELECT status, date_trunc('minute', event_ts) AS minute, count(*) AS n FROM ({RUN_EVENTS_SQL}) GROUP BY 1, 2),"
    " range(1, 6) t(i)) GROUP BY 1, 2",
)
def rate_5m(spark, folder):
    rates = ledger.event_rate(run_events(spark, folder), "event_ts", ["status"])
    return rates.select(
        "status", F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        F.round("rate_per_second", 6).alias("rate_per_second"),
    )


def _quantile_sql(q: float) -> str:
    cases = []
    bounds = ledger.DURATION_BOUNDS
    for i, b in enumerate(bounds):
        below, low = (f"b{i - 1}", bounds[i - 1]) if i else ("0", 0.0)
        cases.append(
            f"WHEN b{i} >= {q} * total THEN {low} + ({b} - {low}) * ({q} * total - {below})"
            f" / CAST(nullif(b{i} - {below}, 0) AS DOUBLE)"
        )
    return f"round(CASE {' '.join(cases)} ELSE {bounds[-1]} END, 6)"


@query(
    "duration_quantiles",
    f"SELECT status, {_quantile_sql(0.5)} AS p50, {_quantile_sql(0.95)} AS p95 FROM (SELECT status, count(duration) AS total, "
    + ", ".join(f"count(*) FILTER (duration <= {b}) AS b{i}" for i, b in enumerate(ledger.DURATION_BOUNDS))
    + f" FROM ({RUN_EVENTS_SQL}) GROUP BY status)",
)
def quantiles(spark, folder):
    found = ledger.duration_quantiles(run_events(spark, folder), [F.col("status")], F.col("duration"))
    return found.select("status", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"))


COUNTED = ("customer", "orders", "lineitem", "events", "documents")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED))
def counts(spark, folder):
    return ledger.table_counts({t: table(spark, folder, t) for t in COUNTED})


@query(
    "score_trend",
    "SELECT pipeline, day, score, round(score - lag(score) OVER (PARTITION BY pipeline ORDER BY day), 2) AS score_delta"
    " FROM (SELECT user_id AS pipeline, CAST(ts AS DATE) AS day, max(value) AS score FROM events GROUP BY 1, 2)",
)
def trend(spark, folder):
    cards = table(spark, folder, "events").groupBy(
        F.col("user_id").alias("pipeline"), F.col("ts").cast("date").alias("day")
    ).agg(F.max("value").alias("score"))
    # One row per day and pipeline, so no key can grow beyond a task.
    return ledger.score_trend(cards, "pipeline", ["day"], "score", hot_key_rows=None)


# --- serving --------------------------------------------------------------------------------------


@query(
    "scoped_rows",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN"
    " (SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"
    "  WHERE r_name = 'ASIA')",
)
def scoped_rows(spark, folder):
    """A region's reader sees the orders of the region's customers."""
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    memberships = customers.join(nations, customers.c_nationkey == nations.n_nationkey).join(
        regions, nations.n_regionkey == regions.r_regionkey
    ).select(F.col("r_name").alias("member"), F.col("c_custkey").alias("scope"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return visible_to(orders, memberships, "ASIA", "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "served_filter_page",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
    " WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 25",
)
def filter_page(spark, folder):
    """Second page of the dearest urgent orders."""
    orders = matching(table(spark, folder, "orders"), o_orderstatus="F", o_orderpriority="1-URGENT")
    return page(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
        [F.desc("o_totalprice"), F.col("o_orderkey")], number=2,
    )


# A third of all events belongs to one user.
ONE_USER = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"


def _asof_sql(comparison: str, within: str) -> str:
    return f"""WITH e AS (SELECT event_id, {ONE_USER} AS person, ts, event_type, value FROM events),
    p AS (SELECT person, ts, max(event_id) AS event_id FROM e WHERE event_type = 'purchase' GROUP BY 1, 2),
    l AS (SELECT * FROM e WHERE event_type <> 'purchase'),
    found AS (SELECT l.event_id, max(p.ts) AS bought_at FROM l JOIN p
        ON p.person = l.person AND p.ts {comparison} l.ts AND p.ts >= l.ts - {within} GROUP BY 1)
    SELECT l.event_id, l.person, l.ts, f.bought_at, p.event_id AS bought FROM l LEFT JOIN found f USING (event_id)
    LEFT JOIN p ON p.person = l.person AND p.ts = f.bought_at"""


def _with_purchase(spark, folder, **options):
    events = table(spark, folder, "events").withColumn("person", F.expr(ONE_USER))
    bought = events.filter("event_type = 'purchase'").select("person", F.col("ts").alias("bought_at"), F.col("event_id").alias("bought"))
    others = events.filter("event_type <> 'purchase'").select("event_id", "person", "ts")
    return asof_join(others, bought, ["person"], "ts", "bought_at", **options)


@query("asof_join", _asof_sql("<", "INTERVAL 1000 DAY"))
def asof_purchase(spark, folder):
    """Every event with its user's latest earlier purchase."""
    return _with_purchase(spark, folder)


@query("asof_join_hot_key", _asof_sql("<=", "INTERVAL 6 HOUR"))
def asof_purchase_of_a_hot_user(spark, folder):
    """The same with purchases of the same moment, up to six hours old, in range pieces: a third of all rows
    are one user's."""
    return _with_purchase(spark, folder, exact=True, most_seconds=6 * 3600, hot_key_rows=1000)


def shop(spark, folder) -> Model:
    """The given tables as a model: whose order, whose customer, which part."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    model = Model({name: (lambda name=name: table(spark, folder, name)) for name in names})
    return (
        model.refers("nation", "region", "n_regionkey", "region", "r_regionkey", reverse="nations")
        .refers("customer", "nation", "c_nationkey", "nation", "n_nationkey")
        .refers("supplier", "nation", "s_nationkey", "nation", "n_nationkey")
        .refers("orders", "customer", "o_custkey", "customer", "c_custkey", reverse="orders")
        .refers("lineitem", "order", "l_orderkey", "orders", "o_orderkey", reverse="lines")
        .refers("lineitem", "part", "l_partkey", "part", "p_partkey")
        .refers("lineitem", "supplier", "l_suppkey", "supplier", "s_suppkey")
    )


@query(
    "filter_by_customer",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_custkey IN"
    " (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def filter_by_customer(spark, folder):
    """One step: orders by their customer's segment."""
    found = shop(spark, folder).filtered("orders", o_orderstatus="F", customer__c_mktsegment="BUILDING")
    return found.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "filter_along_relations",
    """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
    WHERE l_quantity >= 10 AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_custkey IN
            (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN (SELECT n_nationkey FROM nation
                WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA'))))
        AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_nationkey < 15))""",
)
def filter_along_relations(spark, folder):
    """Up to four steps; conditions on one path hold for the same order and customer."""
    return shop(spark, folder).filtered(
        "lineitem", l_quantity__gte=10, order__o_orderstatus__in=["F", "P"], order__customer__c_mktsegment="BUILDING",
        order__customer__nation__region__r_name="ASIA", supplier__nation__n_nationkey__lt=15,
    ).select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "filter_by_referring_rows",
    """SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P'
        AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45))""",
)
def filter_by_referring_rows(spark, folder):
    """Backwards: customers with an order of some status that has a large line; each once."""
    found = shop(spark, folder).filtered("customer", orders__o_orderstatus="P", orders__lines__l_quantity__gt=45)
    return found.select("c_custkey", "c_name")


@query(
    "related_columns",
    """SELECT o_orderkey, c_mktsegment AS segment, n_name AS nation, r_name AS region FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey AND o_custkey % 5 <> 0 LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def related_columns(spark, folder):
    """Orders with what their customers refer to; every fifth customer is unknown."""
    model = shop(spark, folder)
    model.tables["customer"] = lambda: table(spark, folder, "customer").filter("c_custkey % 5 <> 0")
    found = model.with_related(
        model.table("orders"), "orders", segment="customer__c_mktsegment", nation="customer__nation__n_name",
        region="customer__nation__region__r_name",
    )
    return found.select("o_orderkey", "segment", "nation", "region")


@query(
    "served_page_after",
    "SELECT o_orderdate, o_orderkey, o_totalprice FROM orders"
    " WHERE (o_orderdate, o_orderkey) > (TIMESTAMP '1998-01-01', 100) ORDER BY o_orderdate, o_orderkey LIMIT 25",
)
def keyset_page(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return page_after(orders, ["o_orderdate", "o_orderkey"], ("1998-01-01", 100))
