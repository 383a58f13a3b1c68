"""The given tables and the inputs derived from them.

The tables are clean, so the dirt that cleaning and rules work on is derived from them by
expressions that read the same in Spark SQL and in the SQL the results are compared with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


DIRTY_CUSTOMER = (
    "c_custkey",
    "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN '   '"
    " WHEN c_custkey % 5 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS name",
    "CASE WHEN c_custkey % 4 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment",
    "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS balance",
    "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_nationkey END AS nation",
    "CASE WHEN c_custkey % 9 = 0 THEN 'n.a.' WHEN c_custkey % 8 = 0 THEN NULL"
    " ELSE CAST(c_custkey % 120 AS VARCHAR(10)) END AS age",
)
DIRTY_CUSTOMER_SQL = f"SELECT {', '.join(DIRTY_CUSTOMER)} FROM customer"


def dirty_customer(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").selectExpr(*DIRTY_CUSTOMER)


# Events read as a run ledger: a run is a user's day, its status follows the event type.
RUN_EVENTS = (
    "CAST(user_id AS VARCHAR(20)) || '/' || CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS run_id",
    "user_id AS pipeline",
    "CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'click' THEN 'RUNNING'"
    " WHEN 'view' THEN 'RETRYING' WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'FAILED' END AS status",
    "ts AS event_ts",
    "event_id AS seq",
    "value / 50.0 AS duration",
    "props AS metrics",
)
RUN_EVENTS_SQL = f"SELECT {', '.join(RUN_EVENTS)} FROM events"
RUNS_SQL = (
    f"SELECT * FROM ({RUN_EVENTS_SQL}) QUALIFY"
    " row_number() OVER (PARTITION BY run_id ORDER BY event_ts DESC, seq DESC) = 1"
)


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(*RUN_EVENTS)
