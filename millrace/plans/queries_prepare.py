"""Registered queries: scans, incremental reads, cleaning, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import mask_email
from millrace.lake import files
from millrace.operators.clean import clean, clean_stats
from millrace.operators.incremental import filter_incremental, watermark_max
from millrace.operators.transform import dedupe_keep_first, transform
from millrace.plans.inputs import DIRTY_CUSTOMER_SQL, dirty_customer, table
from millrace.session import scratch_path
from millrace.sources import POSITION, extract
from millrace.sources.csv import read_csv
from millrace.sources.pages import landed_pages, page_columns, page_drift

QUERIES = {}


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function

    return keep


@query(
    "scan_csv_typed",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
    " strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority FROM orders",
)
def scan_csv_typed(spark, folder):
    path = scratch_path(spark, "csv")
    text = table(spark, folder, "orders").withColumn(
        "o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    )
    text.write.csv(path, header=True, escape='"')
    return read_csv(spark, path).drop(POSITION)


PAGE_ROWS = 250


@query("paged_json_union", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def paged_json_union(spark, folder):
    """All pages count; the page after them is empty, and one more behind it must not be read."""
    path = scratch_path(spark, "pages")
    customers = table(spark, folder, "customer")
    page = F.floor(F.col("c_custkey") / PAGE_ROWS) + 1
    pages = customers.groupBy(page.alias("page")).agg(
        F.to_json(F.collect_list(F.struct(*customers.columns))).alias("value")
    )
    ends = customers.agg(F.max(page).alias("last")).select(
        F.inline(
            F.array(
                F.struct((F.col("last") + 1).alias("page"), F.lit("[]").alias("value")),
                F.struct((F.col("last") + 2).alias("page"), F.lit('[{"c_custkey": -1}]').alias("value")),
            )
        )
    )
    pages.unionByName(ends).write.partitionBy("page").text(path)
    return extract(
        spark, "rest_api",
        {"path": f"{path}/*/*.txt", "page_pattern": r"page=(\d+)/",
         "schema": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"},
    ).drop(POSITION)


def _differing_pages(spark, folder) -> dict:
    """Landed pages whose records differ: even pages lack the balance, each third one has nations as text, and
    the first page and those from the fifth on have a segment."""
    path = scratch_path(spark, "pages")
    page = F.floor(F.col("c_custkey") / PAGE_ROWS) + 1
    customers = table(spark, folder, "customer").withColumn("page", page)
    record = F.to_json(F.struct(
        "c_custkey", F.when(F.col("page") % 2 != 0, F.col("c_acctbal")).alias("c_acctbal"),
        F.when(F.col("page") % 3 != 0, F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("page") % 3 == 0, F.concat(F.lit("n"), "c_nationkey")).alias("nation_text"),
        F.when((F.col("page") >= 5) | (F.col("page") == 1), F.col("c_mktsegment")).alias("segment"),
    ))
    record = F.replace(record, F.lit('"nation_text"'), F.lit('"c_nationkey"'))
    pages = customers.groupBy("page").agg(
        F.concat(F.lit('{"data": ['), F.array_join(F.collect_list(record), ","), F.lit("]}")).alias("value")
    )
    pages.write.partitionBy("page").text(path)
    return {"path": f"{path}/*/*.txt", "page_pattern": r"page=(\d+)/", "results_path": "data"}


PAGED_SQL = f"(SELECT *, c_custkey // {PAGE_ROWS} + 1 AS page FROM customer)"


@query(
    "pages_that_differ",
    f"""SELECT c_custkey, CASE WHEN page % 2 <> 0 THEN c_acctbal END AS c_acctbal,
        CASE WHEN page % 3 = 0 THEN 'n' ELSE '' END || CAST(c_nationkey AS VARCHAR) AS c_nationkey,
        CASE WHEN page >= 5 OR page = 1 THEN c_mktsegment END AS segment FROM {PAGED_SQL}""",
)
def pages_that_differ(spark, folder):
    """Columns and types come from the pages: what some lack is NULL, what differs in type is text."""
    config = _differing_pages(spark, folder)
    return extract(spark, "rest_api", config).drop(POSITION).select(
        "c_custkey", "c_acctbal", F.col("c_nationkey").cast("string").alias("c_nationkey"), "segment"
    )


@query(
    "page_drift",
    f"""WITH p AS (SELECT DISTINCT page FROM {PAGED_SQL}),
    c AS (SELECT page, 'c_custkey' AS name, 'BIGINT' AS dtype FROM p
        UNION ALL SELECT page, 'c_acctbal', 'number' FROM p WHERE page % 2 <> 0
        UNION ALL SELECT page, 'c_nationkey', CASE WHEN page % 3 = 0 THEN 'STRING' ELSE 'BIGINT' END FROM p
        UNION ALL SELECT page, 'segment', 'STRING' FROM p WHERE page >= 5 OR page = 1)
    SELECT coalesce(a.page, b.page + 1) AS page, coalesce(a.name, b.name) AS name,
        CASE WHEN b.name IS NULL THEN 'added' WHEN a.name IS NULL THEN 'removed' ELSE 'type' END AS change
    FROM c a FULL JOIN c b ON a.page = b.page + 1 AND a.name = b.name
    WHERE a.dtype IS DISTINCT FROM b.dtype AND coalesce(a.page, b.page + 1) BETWEEN 2 AND (SELECT max(page) FROM p)""",
)
def drift_of_pages(spark, folder):
    """What each page's records have otherwise than those of the page before."""
    columns = page_columns(landed_pages(spark, _differing_pages(spark, folder)))
    return page_drift(columns).select("page", "name", "change")


@query(
    "pages_as_a_source",
    f"""SELECT page, c_custkey - CASE WHEN page = 1 THEN (SELECT min(c_custkey) FROM customer) ELSE (page - 1) * {PAGE_ROWS} END AS at,
        c_custkey, c_name FROM {PAGED_SQL} WHERE page >= 2 AND page <= 4""",
)
def pages_as_a_source(spark, folder):
    """The format ``landed_pages``: one partition per page, and only the pages asked for are opened."""
    path = scratch_path(spark, "pages")
    page = F.floor(F.col("c_custkey") / PAGE_ROWS) + 1
    records = table(spark, folder, "customer").select("c_custkey", "c_name").withColumn("page", page)
    listed = F.array_sort(F.collect_list(F.struct("c_custkey", "c_name")))
    records.groupBy("page").agg(F.to_json(listed).alias("value")).repartition("page").sortWithinPartitions("page").write.partitionBy(
        "page"
    ).text(path)
    # The writer names files by task, so each is given its folder's number.
    for folder_name in files.child_folders(spark, path):
        (name,) = files.names(spark, f"{path}/{folder_name}")
        files.rename(spark, f"{path}/{folder_name}/{name}", f"{path}/{folder_name}/page-{folder_name.split('=')[1]}.json")
    found = extract(spark, "landed_pages", {"path": path, "schema": "c_custkey bigint, c_name string"})
    return found.filter("page >= 2 AND page <= 4").select("page", "at", "c_custkey", "c_name")


@query(
    "clean_trim_lower",
    f"SELECT c_custkey, nullif(trim(name), '') AS name, lower(segment) AS segment FROM ({DIRTY_CUSTOMER_SQL})",
)
def clean_trim_lower(spark, folder):
    return clean(
        dirty_customer(spark, folder).select("c_custkey", "name", "segment"),
        {"trim": ["name", "no_such_column"], "lowercase": ["segment"]},
    )


@query(
    "clean_fill_null",
    "SELECT c_custkey, coalesce(name, 'UNKNOWN') AS name, coalesce(balance, 0.0) AS balance,"
    f" coalesce(nation, -1) AS nation, coalesce(age, 'unknown') AS age FROM ({DIRTY_CUSTOMER_SQL})",
)
def clean_fill_null(spark, folder):
    spec = {"fill_null": {"name": "UNKNOWN", "balance": 0.0, "nation": -1, "age": "unknown"}}
    return clean(dirty_customer(spark, folder).drop("segment"), spec)


@query(
    "clean_drop_missing",
    f"SELECT * FROM ({DIRTY_CUSTOMER_SQL}) WHERE name IS NOT NULL AND balance IS NOT NULL",
)
def clean_drop_missing(spark, folder):
    return clean(dirty_customer(spark, folder), {"drop_rows_missing": ["name", "balance"]})


PRESENT_SQL = " + ".join(
    f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)"
    for c in ("c_custkey", "name", "segment", "balance", "nation", "age")
)


@query("clean_min_present", f"SELECT * FROM ({DIRTY_CUSTOMER_SQL}) WHERE {PRESENT_SQL} >= 5")
def clean_min_present(spark, folder):
    return clean(dirty_customer(spark, folder), {"min_present_fraction": 0.9})


FULL_CLEAN = {
    "trim": ["name"], "lowercase": ["name", "segment"], "fill_null": {"nation": -1},
    "drop_rows_missing": ["name"], "min_present_fraction": 0.9,
}
FULL_CLEAN_STEPS_SQL = (
    "SELECT c_custkey, lower(nullif(trim(name), '')) AS name, lower(segment) AS segment, balance,"
    " coalesce(nation, -1) AS nation, age, name AS name0, trim(name) AS name1, segment AS segment0,"
    f" nation AS nation0 FROM ({DIRTY_CUSTOMER_SQL})"
)


@query(
    "clean_full",
    f"SELECT c_custkey, name, segment, balance, nation, age FROM ({FULL_CLEAN_STEPS_SQL})"
    f" WHERE name IS NOT NULL AND {PRESENT_SQL} >= 5",
)
def clean_full(spark, folder):
    return clean(dirty_customer(spark, folder), FULL_CLEAN)


@query(
    "clean_stats",
    "SELECT count(*) FILTER (name0 <> name1) AS cells_trimmed,"
    " count(*) FILTER (name1 <> '' AND name1 <> lower(name1)) + count(*) FILTER (segment0 <> segment) AS cells_lowercased,"
    " count(*) FILTER (nation0 IS NULL) AS cells_filled,"
    f" count(*) FILTER (name IS NULL OR {PRESENT_SQL} < 5) AS rows_dropped FROM ({FULL_CLEAN_STEPS_SQL})",
)
def cleaning_counters(spark, folder):
    return clean_stats(dirty_customer(spark, folder), FULL_CLEAN)


@query(
    "dedupe_keep_first",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
    " QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1",
)
def first_order(spark, folder):
    return dedupe_keep_first(
        table(spark, folder, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]
    )


@query(
    "transform_full",
    "SELECT customer_id, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(trunc(o_totalprice) AS BIGINT) AS total,"
    " o_orderstatus AS status FROM (SELECT *, CAST(o_custkey AS VARCHAR) AS customer_id FROM orders)"
    " QUALIFY row_number() OVER (PARTITION BY customer_id, o_orderstatus ORDER BY o_orderdate, o_orderkey) = 1",
)
def transform_full(spark, folder):
    spec = {
        "rename": {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_totalprice": "total",
                   "o_orderstatus": "status", "not_there": "ignored"},
        "cast": {"order_id": "str", "customer_id": "str", "total": "int64"},
        "drop_duplicates": ["customer_id", "status"],
        "select": ["customer_id", "order_id", "total", "status"],
    }
    order = [F.col("o_orderdate"), F.col("order_id").cast("bigint")]
    return transform(table(spark, folder, "orders"), spec, order)


EVENT_COLUMNS = "event_id, ts, user_id, event_type, value"


def _events(spark, folder):
    return table(spark, folder, "events").drop("props")


@query("incremental_time", f"SELECT {EVENT_COLUMNS} FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'")
def incremental_time(spark, folder):
    return filter_incremental(_events(spark, folder), "ts", "2024-01-15 12:00:00")


@query("incremental_grace", f"SELECT {EVENT_COLUMNS} FROM events WHERE ts > TIMESTAMP '2024-01-15 11:00:00'")
def incremental_grace(spark, folder):
    return filter_incremental(_events(spark, folder), "ts", "2024-01-15 12:00:00", grace_seconds=3600)


@query(
    "incremental_text_time",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS seen FROM events"
    " WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-15 11:30:00'",
)
def incremental_text_time(spark, folder):
    """Times that arrive as text, as they do from CSV."""
    seen = _events(spark, folder).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seen"))
    return filter_incremental(seen, "seen", "2024-01-15 12:00:00", grace_seconds=1800)


@query("incremental_lexical", f"SELECT {EVENT_COLUMNS} FROM events WHERE event_type > 'error'")
def incremental_lexical(spark, folder):
    return filter_incremental(_events(spark, folder), "event_type", "error", grace_seconds=60)


@query("incremental_numeric", f"SELECT {EVENT_COLUMNS} FROM events WHERE event_id > 9")
def incremental_numeric(spark, folder):
    return filter_incremental(_events(spark, folder), "event_id", "9")


@query(
    "watermark_max",
    "SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS by_time, CAST(max(event_id) AS VARCHAR) AS by_number,"
    " max(event_type) AS by_text FROM events",
)
def newest_values(spark, folder):
    events = _events(spark, folder)
    return events.agg(
        F.substring(watermark_max(events, "ts"), 1, 19).alias("by_time"),
        watermark_max(events, "event_id").alias("by_number"),
        watermark_max(events, "event_type").alias("by_text"),
    )


EMAIL = (
    "CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN c_name"
    " WHEN c_custkey % 5 = 0 THEN '@' || lower(c_mktsegment) || '.com' WHEN c_custkey % 4 = 0 THEN c_name || '@'"
    " WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name || '@' || lower(c_mktsegment) || '@x.com' END"
)


@query(
    "mask_email",
    "SELECT c_custkey, CASE WHEN email IS NULL THEN NULL WHEN email = '' OR strpos(email, '@') = 1 THEN email"
    " WHEN strpos(email, '@') = 0 OR strpos(email, '@') = length(email) THEN left(email, 1) || '***'"
    " ELSE left(email, 1) || '***@' || substr(email, strpos(email, '@') + 1) END AS email,"
    f" email AS email_for_engineers FROM (SELECT c_custkey, {EMAIL} AS email FROM customer)",
)
def masked_addresses(spark, folder):
    rows = table(spark, folder, "customer").selectExpr("c_custkey", f"{EMAIL} AS email")
    return rows.select(
        "c_custkey", mask_email(F.col("email")).alias("email"),
        mask_email(F.col("email"), privileged=True).alias("email_for_engineers"),
    )
