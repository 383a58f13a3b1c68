"""Every registered query against its SQL, on the smallest tables."""

import importlib.util
import os
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


registered = load("spark_entry", ROOT / "__spark_entry__.py")
compare = load("compare", ROOT / "tools" / "compare.py")


# Queries of the optional subpackage have tests of their own.
NAMES = sorted(set(registered.queries()) - set(registered._LLM))


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in compare.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(NAMES) == set(registered.oracle_sql()) - set(registered._LLM)


def test_entry(spark):
    assert registered.entry(spark).count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    result = compare.compare(spark, con, FOLDER, name)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", ["scd2_merge", "scorecard", "upsert_type1", "run_dashboard", "rate_5m", "lineage_graph"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = registered.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
