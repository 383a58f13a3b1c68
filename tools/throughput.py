"""Rows per second of a whole ingest run: 20,000 CSV rows, then all customers and all orders.

    python tools/throughput.py [folder]
"""

from __future__ import annotations

import sys
import tempfile
import time
from datetime import datetime
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from millrace.plans.ingest import PipelineSpec, run_ingest  # noqa: E402

RULES = {"rules": [
    {"type": "required_columns", "columns": ["customer_id", "email"]},
    {"type": "not_null", "columns": ["email"]},
    {"type": "unique", "columns": ["customer_id"]},
]}
CLEAN = {"clean": {"trim": ["email", "first_name"], "lowercase": ["email"], "fill_null": {"country": "UNKNOWN"}}}


def people(df, key: str):
    name = F.concat(F.lit("u"), F.col(key).cast("string"))
    return df.select(
        F.concat(F.lit("chaos-"), F.col(key).cast("string")).alias("customer_id"),
        name.alias("first_name"), F.lit("Test").alias("last_name"),
        F.concat(F.lit(" "), name, F.lit("@Example.com")).alias("email"),
        F.lit("2024-01-01").alias("signup_date"),
        F.when(F.col(key) % 10 > 0, F.lit("US")).alias("country"),
    )


def main():
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = tempfile.mkdtemp(prefix="run-")
    people(spark.range(20_000), "id").coalesce(1).write.csv(f"{root}/csv", header=True)
    people(spark.read.parquet(f"{folder}/orders.parquet"), "o_orderkey").write.parquet(f"{root}/orders")
    sources = {
        "csv 20,000 rows": {"type": "file", "path": f"{root}/csv"},
        "parquet, one row per order": {"type": "parquet", "path": f"{root}/orders"},
    }
    for target in ("customers", "customers_scd2"):
        for label, source in sources.items():
            for round_no in range(2):
                spec = PipelineSpec("p", source, target=target, validation=RULES, transform=CLEAN, order_by=["customer_id"])
                began = time.perf_counter()
                r = run_ingest(spark, f"{root}/{target}", spec, f"{label[:3]}-{round_no}", datetime(2024, 1, 1))
                took = time.perf_counter() - began
                print(f"{target:15} {label:28} run {round_no}: {r.rows_loaded} rows, {took:.2f} s,"
                      f" {r.rows_loaded / took:,.0f} rows/s, {r.load_result}", flush=True)


if __name__ == "__main__":
    main()
