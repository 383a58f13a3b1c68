"""Registered queries: rules, scores, statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.operators import rules, sketches
from millrace.operators.rules import quarantine_split
from millrace.operators.scorecard import scorecard
from millrace.operators.statistics import backtest, column_moments, merge_baseline, z_scores
from millrace.plans.inputs import DIRTY_CUSTOMER_SQL, dirty_customer, table
from millrace.session import scratch_path

QUERIES = {}


def rule_results(df, checks, as_of=None):
    """The counts without their wording."""
    return rules.rule_results(df, checks, as_of).drop("message")


def query(name: str, sql: str | None = None):
    def keep(function):
        QUERIES[name] = (function, sql)
        return function

    return keep


def _checks_sql(checks: list[tuple], source: str, extra: str = "") -> str:
    """UNION of one row per rule; each check is (rule_type, severity, violations, checked)."""
    rows = [
        f"SELECT {i} AS position, '{kind}' AS rule_type, CAST({bad} AS BIGINT) = 0 AS passed,"
        f" '{severity}' AS severity, CAST({bad} AS BIGINT) AS violation_count,"
        f" CAST({checked} AS BIGINT) AS checked_count FROM batch"
        for i, (kind, severity, bad, checked) in enumerate(checks)
    ]
    return f"WITH {extra} batch AS ({source}) " + " UNION ALL ".join(rows)


NUMBER_SQL = "TRY_CAST(age AS DOUBLE)"


@query(
    "rule_row_counts",
    _checks_sql(
        [
            ("not_null", "blocking", "2 * count(*) - count(name) - count(balance)", "2 * count(*)"),
            ("column_type", "blocking", f"count(*) FILTER (age IS NOT NULL AND {NUMBER_SQL} IS NULL)", "count(*)"),
            ("column_type", "blocking", "0", "count(*)"),
            ("range", "warning", f"count(*) FILTER ({NUMBER_SQL} < 18 OR {NUMBER_SQL} > 99)", "count(*)"),
            ("range", "blocking", "count(*) FILTER (balance < 0)", "count(*)"),
            ("allowed_values", "warning",
             "count(*) FILTER (segment IS NULL OR segment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD'))", "count(*)"),
            ("allowed_values", "blocking", "count(*) FILTER (nation IS NULL OR nation NOT IN (1, 2, 3))", "count(*)"),
        ],
        DIRTY_CUSTOMER_SQL,
    ),
)
def rule_row_counts(spark, folder):
    return rule_results(
        dirty_customer(spark, folder),
        [
            {"type": "not_null", "columns": ["name", "balance", "no_such_column"]},
            {"type": "column_type", "column": "age", "expected_type": "int"},
            {"type": "column_type", "column": "name", "expected_type": "str"},
            {"type": "range", "column": "age", "min": 18, "max": 99, "severity": "warning"},
            {"type": "range", "column": "balance", "min": 0},
            {"type": "allowed_values", "column": "segment", "values": ["BUILDING", "MACHINERY", "HOUSEHOLD"],
             "severity": "warning"},
            {"type": "allowed_values", "column": "nation", "values": [1, 2, 3, "4"]},
        ],
    )


@query(
    "rule_unique",
    _checks_sql(
        [
            ("unique", "blocking", "count(*) - count(DISTINCT o_orderkey)", "count(*)"),
            ("unique", "warning",
             "2 * count(*) - count(DISTINCT o_custkey) - count(DISTINCT clerk) - 1", "2 * count(*)"),
        ],
        "SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority || o_custkey END AS clerk FROM orders",
    ),
)
def rule_unique(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "clerk", F.expr("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority || o_custkey END")
    )
    return rule_results(
        orders,
        [
            {"type": "unique", "columns": ["o_orderkey"]},
            {"type": "unique", "columns": ["o_custkey", "clerk"], "severity": "warning"},
        ],
    )


@query("rule_unique_approx", QUERIES["rule_unique"][1])
def rule_unique_approx(spark, folder):
    """By sketch; exact up to 65,536 different values."""
    orders = table(spark, folder, "orders").withColumn(
        "clerk", F.expr("CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority || o_custkey END")
    )
    return rule_results(
        orders,
        [
            {"type": "unique", "columns": ["o_orderkey"], "approx": True},
            {"type": "unique", "columns": ["o_custkey", "clerk"], "severity": "warning", "approx": True},
        ],
    )


RANKS = (0.05, 0.5, 0.95)


@query(
    "sketched_quantiles",
    """SELECT event_type, CAST(rank AS DOUBLE) AS rank, count(*) AS n, true AS within FROM events, (VALUES (0.05), (0.5), (0.95)) r(rank)
    WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-22' GROUP BY 1, 2""",
)
def sketched_quantiles(spark, folder):
    """Quantiles over two weeks from one sketch a day: whether the exact rank of each is within the stated error."""
    root = scratch_path(spark, "sketches")
    events = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    sketches.sketch_columns(events, ["value"], ["event_type", "day"]).write.parquet(root)
    weeks = (F.col("day") >= F.lit("2024-01-08").cast("date")) & (F.col("day") < F.lit("2024-01-22").cast("date"))
    stored = spark.read.parquet(root).filter(weeks)
    wide = sketches.quantiles(stored, ["event_type"], list(RANKS))
    found = wide.unpivot(["event_type", "n"], [c for c in wide.columns if c.startswith("p")], "name", "estimate")
    found = found.withColumn("rank", F.expr("round(try_cast(substr(name, 2) AS double) / 100, 4)"))
    # The exact ranks, by the few estimates against all rows of their type.
    below, upto = F.count(F.when(F.col("value") < F.col("estimate"), 1)), F.count(F.when(F.col("value") <= F.col("estimate"), 1))
    total = F.count("value")
    close = (below / total - F.lit(sketches.RANK_ERROR) <= F.col("rank")) & (F.col("rank") <= upto / total + F.lit(sketches.RANK_ERROR))
    judged = events.filter(weeks).join(F.broadcast(found), "event_type").groupBy("event_type", "rank", "n")
    return judged.agg(close.alias("within")).select("event_type", "rank", F.col("n").cast("bigint").alias("n"), "within")


@query(
    "sketched_new_values",
    """WITH v AS (SELECT 'o_custkey' AS "column", CAST(o_custkey AS VARCHAR) AS value, o_orderdate FROM orders
        UNION ALL SELECT 'o_clerk', o_orderpriority || (o_custkey % 100), o_orderdate FROM orders),
    late AS (SELECT DISTINCT "column", value FROM v WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
    early AS (SELECT DISTINCT "column", value FROM v WHERE o_orderdate < TIMESTAMP '1998-01-01')
    SELECT "column", count(*) AS distinct_values, count(*) FILTER (value NOT IN (SELECT value FROM early e WHERE e."column" = late."column")) AS new_values
    FROM late GROUP BY 1""",
)
def sketched_new_values(spark, folder):
    """How many customers and clerks of the last year no year before had; exact, as there are few."""
    orders = table(spark, folder, "orders").withColumns({
        "o_clerk": F.concat("o_orderpriority", (F.col("o_custkey") % 100).cast("string")), "year": F.year("o_orderdate"),
    })
    by_year = sketches.sketch_columns(orders, ["o_custkey", "o_clerk"], ["year"])
    found = sketches.new_values(by_year.filter("year < 1998"), by_year.filter("year >= 1998"), ["column"])
    return found.select("column", *[F.round(c).cast("bigint").alias(c) for c in ("distinct_values", "new_values")])


@query(
    "rule_duplicate_rows",
    _checks_sql(
        [
            ("unique", "warning", "count(*) - count(DISTINCT text)", "count(*)"),
            ("no_duplicate_rows", "warning", "count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents))",
             "count(*)"),
        ],
        "SELECT text, lang FROM documents",
    ),
)
def rule_duplicate_rows(spark, folder):
    """Whole texts are compared, as length and digest."""
    return rule_results(
        table(spark, folder, "documents").select("text", "lang"),
        [
            {"type": "unique", "columns": ["text"], "severity": "warning"},
            {"type": "no_duplicate_rows", "severity": "warning"},
        ],
    )


AS_OF = datetime(2002, 1, 1)
AGE_SQL = "(SELECT date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '2002-01-01') FROM orders)"


@query(
    "rule_freshness",
    _checks_sql(
        [
            ("freshness", "warning", f"CASE WHEN {AGE_SQL} > 30 THEN 1 ELSE 0 END", "1"),
            ("freshness", "blocking", f"CASE WHEN {AGE_SQL} > 3650 THEN 1 ELSE 0 END", "1"),
            ("freshness", "warning", "(SELECT count(*) FROM orders)", "(SELECT count(*) FROM orders)"),
        ],
        "SELECT 1",
    ),
)
def rule_freshness(spark, folder):
    orders = table(spark, folder, "orders").withColumn("placed", F.col("o_orderdate").cast("string"))
    return rule_results(
        orders,
        [
            {"type": "freshness", "column": "o_orderdate", "max_age_days": 30},
            {"type": "freshness", "column": "placed", "max_age_days": 3650, "severity": "blocking"},
            {"type": "freshness", "column": "o_orderpriority", "max_age_days": 3650},
        ],
        as_of=AS_OF,
    )


@query(
    "rule_business",
    _checks_sql(
        [
            ("cheap_or_small", "blocking",
             "count(*) - count(*) FILTER (l_extendedprice < 40000 OR l_quantity <= 25)", "count(*)"),
            ("low_tax", "warning",
             "count(*) - count(*) FILTER (CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END <= 0.05)", "count(*)"),
            ("broken", "warning", "count(*)", "count(*)"),
        ],
        "SELECT * FROM lineitem",
    ),
)
def rule_business(spark, folder):
    return rule_results(
        table(spark, folder, "lineitem"),
        [
            {"type": "business_rule", "name": "cheap_or_small", "expression": "l_extendedprice < 40000 or l_quantity <= 25"},
            {"type": "business_rule", "name": "low_tax", "severity": "warning",
             "expression": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax END <= 0.05"},
            {"type": "business_rule", "name": "broken", "severity": "warning", "expression": "no_such_column > 1"},
        ],
    )


# Numbers at the edge of their type, and divisors that are sometimes zero.
EDGE = "CASE WHEN l_linenumber = 1 THEN 9223372036854775807 - l_orderkey % 3 ELSE l_orderkey END"


@query(
    "rule_business_uncomputable",
    _checks_sql(
        [
            ("next_is_positive", "blocking", "count(*) FILTER (edge >= 9223372036854775807)", "count(*)"),
            ("two_more", "blocking", "count(*) FILTER (edge >= 9223372036854775806)", "count(*)"),
            ("narrow", "warning", "count(*) FILTER (edge > 127)", "count(*)"),
            ("ratio", "warning", "count(*) FILTER (l_linenumber = 3 OR l_quantity / CAST(l_linenumber - 3 AS DOUBLE) <= 1)", "count(*)"),
            ("flag_is_number", "warning", "count(*)", "count(*)"),
        ],
        f"SELECT *, {EDGE} AS edge FROM lineitem",
    ),
)
def rule_business_uncomputable(spark, folder):
    """Rows on which a rule overflows, divides by zero or does not cast break it."""
    return rule_results(
        table(spark, folder, "lineitem").withColumn("edge", F.expr(EDGE).cast("bigint")),
        [
            {"type": "business_rule", "name": "next_is_positive", "expression": "edge + 1 > 0"},
            {"type": "business_rule", "name": "two_more", "expression": "edge + 1 + 1 <> 0"},
            {"type": "business_rule", "name": "narrow", "severity": "warning", "expression": "cast(edge AS tinyint) >= 0"},
            {"type": "business_rule", "name": "ratio", "severity": "warning", "expression": "l_quantity / (l_linenumber - 3) > 1"},
            {"type": "business_rule", "name": "flag_is_number", "severity": "warning", "expression": "cast(l_returnflag AS int) IS NULL"},
        ],
    )


BAD_KEY = "CASE WHEN o_orderpriority = '5-LOW' THEN -o_custkey - 1 WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END"


@query(
    "rule_foreign_key",
    _checks_sql(
        [
            ("foreign_key", "blocking",
             "count(*) FILTER (buyer IS NOT NULL AND buyer NOT IN (SELECT c_custkey FROM customer))", "count(*)"),
            ("foreign_key", "blocking", "0", "count(*)"),
        ],
        f"SELECT {BAD_KEY} AS buyer, o_custkey FROM orders",
    ),
)
def rule_foreign_key(spark, folder):
    customers = table(spark, folder, "customer")
    orders = table(spark, folder, "orders").withColumn("buyer", F.expr(BAD_KEY))
    return rule_results(
        orders,
        [
            {"type": "foreign_key", "column": c, "parent": customers, "parent_column": "c_custkey"}
            for c in ("buyer", "o_custkey")
        ],
    )


@query(
    "scorecard",
    f"""WITH batch AS (SELECT name, segment, balance, nation, age FROM ({DIRTY_CUSTOMER_SQL})),
    m AS (SELECT CAST(count(*) AS DOUBLE) AS n,
        5.0 * count(*) - count(name) - count(segment) - count(balance) - count(nation) - count(age) AS nulls,
        (SELECT count(*) FROM (SELECT DISTINCT * FROM batch)) AS different,
        count(*) FILTER (age IS NOT NULL AND {NUMBER_SQL} IS NULL) AS not_a_number,
        count(*) FILTER (balance < 0 OR balance > 5000) AS outside,
        count(*) - count(*) FILTER (balance > 1000 OR segment = 'BUILDING') AS poor FROM batch),
    s AS (SELECT 100.0 * (1 - nulls / (5 * n)) AS a, 100.0 * (different / n) AS b,
        (100.0 * (1 - not_a_number / n) + 100.0 * (1 - outside / n) + 100.0 * (1 - poor / n) + 100.0) / 4 AS c FROM m)
    SELECT round(a, 2) AS completeness, round(b, 2) AS consistency, round(c, 2) AS accuracy,
        round((a + b + c) / 3, 2) AS overall_score FROM s""",
)
def batch_scores(spark, folder):
    return scorecard(
        dirty_customer(spark, folder).drop("c_custkey"),
        {
            "rules": [
                {"type": "not_null", "columns": ["name"], "severity": "warning"},
                {"type": "column_type", "column": "age", "expected_type": "float", "severity": "warning"},
                {"type": "range", "column": "balance", "min": 0, "max": 5000, "severity": "warning"},
                {"type": "business_rule", "name": "solvent", "expression": "balance > 1000 OR segment = 'BUILDING'",
                 "severity": "warning"},
                {"type": "no_such_rule", "severity": "warning"},
            ]
        },
    )


@query(
    "quarantine_split",
    "SELECT l_orderkey, l_linenumber, l_quantity, NOT (l_quantity <= 45 AND l_discount >= 0.01"
    " AND coalesce(l_shipmode, '') <> '') AS is_quarantined FROM"
    " (SELECT *, CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE 'RAIL' END AS l_shipmode FROM lineitem)",
)
def quarantine(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn(
        "l_shipmode", F.expr("CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN NULL ELSE 'RAIL' END")
    )
    return quarantine_split(
        lines,
        [
            {"type": "not_null", "columns": ["l_shipmode"]},
            {"type": "range", "column": "l_quantity", "max": 45},
            {"type": "business_rule", "expression": "l_discount >= 0.01"},
            {"type": "business_rule", "expression": "l_tax > 100", "severity": "warning"},
        ],
    ).select("l_orderkey", "l_linenumber", "l_quantity", "is_quarantined")


LINE_NUMBERS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "column_moments",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean,"
        f" round(sqrt(var_pop({c})), 4) AS stddev FROM lineitem"
        for c in LINE_NUMBERS
    ),
)
def line_moments(spark, folder):
    found = column_moments(table(spark, folder, "lineitem"))
    return found.select(
        "column", "count", F.round("mean", 4).alias("mean"), F.round(F.sqrt("variance"), 4).alias("stddev")
    )


def _moments_by_type(events):
    return events.groupBy(F.col("event_type").alias("column")).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance")
    )


def _history_and_batch(spark, folder):
    """Moments per event type before and after a day; the baseline carries m2 instead of variance."""
    events = table(spark, folder, "events")
    split = F.lit("2024-01-29").cast("timestamp_ntz")
    before = _moments_by_type(events.filter(F.col("ts") < split))
    baseline = before.select("column", "count", "mean", (F.col("variance") * F.col("count")).alias("m2"))
    return baseline, _moments_by_type(events.filter(F.col("ts") >= split))


@query(
    "baseline_merge",
    "SELECT event_type AS \"column\", count(*) AS count, round(avg(value), 4) AS mean,"
    " round(var_pop(value) * count(*), 2) AS m2 FROM events GROUP BY event_type",
)
def merged_baseline(spark, folder):
    baseline, batch = _history_and_batch(spark, folder)
    merged = merge_baseline(batch, baseline, ["column"])
    return merged.select("column", "count", F.round("mean", 4).alias("mean"), F.round("m2", 2).alias("m2"))


@query(
    "anomaly_zscore",
    """WITH b AS (SELECT event_type, avg(value) AS m, sqrt(var_pop(value)) AS s FROM events
        WHERE ts < TIMESTAMP '2024-01-29' GROUP BY event_type),
    n AS (SELECT event_type, avg(value) AS m FROM events WHERE ts >= TIMESTAMP '2024-01-29' GROUP BY event_type)
    SELECT event_type AS "column", round(n.m, 4) AS value, round(b.m, 4) AS baseline_mean,
        round(b.s, 4) AS baseline_stddev, round((n.m - b.m) / b.s, 4) AS z_score,
        abs((n.m - b.m) / b.s) > 3 AS is_anomaly FROM n JOIN b USING (event_type)""",
)
def batch_z_scores(spark, folder):
    baseline, batch = _history_and_batch(spark, folder)
    judged = z_scores(batch, baseline, ["column"])
    return judged.select(
        "column", *[F.round(c, 4).alias(c) for c in ("value", "baseline_mean", "baseline_stddev", "z_score")],
        "is_anomaly",
    )


@query(
    "anomaly_backtest",
    """WITH r AS (SELECT user_id, CAST(ts AS DATE) AS run, count(*) AS n, avg(value) AS mean,
        var_pop(value) AS v FROM events GROUP BY 1, 2),
    b AS (SELECT *, coalesce(sum(n) OVER w, 0) AS c,
        sum(n * mean) OVER w / sum(n) OVER w AS bm,
        sum(n * v + n * mean * mean) OVER w / sum(n) OVER w AS q FROM r
        WINDOW w AS (PARTITION BY user_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    z AS (SELECT *, sqrt(greatest(q - bm * bm, 0)) AS bs FROM b)
    SELECT user_id, run, CAST(n AS BIGINT) AS count, CAST(c AS BIGINT) AS baseline_count,
        round(bm, 8) AS baseline_mean, round(CASE WHEN c >= 3 AND bs > 1e-6 THEN (mean - bm) / bs END, 6) AS z_score,
        coalesce(c >= 3 AND bs > 1e-6 AND abs((mean - bm) / bs) > 3, false) AS is_anomaly FROM z""",
)
def daily_backtest(spark, folder):
    """Every user's day judged against all days before it."""
    runs = table(spark, folder, "events").groupBy("user_id", F.col("ts").cast("date").alias("run")).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.var_pop("value").alias("variance")
    )
    # One row per day and user, so no key can grow beyond a task.
    judged = backtest(runs, ["user_id"], ["run"], hot_key_rows=None)
    return judged.select(
        "user_id", "run", "count", "baseline_count", F.round("baseline_mean", 8).alias("baseline_mean"),
        F.round("z_score", 6).alias("z_score"), "is_anomaly",
    )
