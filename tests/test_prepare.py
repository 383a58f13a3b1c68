"""Incremental reads, cleaning, reshaping."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.errors import TransformError
from millrace.functions.numbers import parse_number
from millrace.functions.text import WHITESPACE, mask_email, strip
from millrace.functions.types import nan_to_null
from millrace.operators.clean import clean, clean_observed, clean_stats
from millrace.operators.incremental import advance_watermark, compute_watermark, filter_incremental, watermark_kind
from millrace.operators.transform import dedupe_keep_first, transform


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(df, column):
    return sorted(r[0] for r in df.select(column).collect())


# incremental

def times(spark, kind="string"):
    df = frame(spark, "updated_at string, v int", ("2024-01-01", 1), ("2024-01-05", 2), ("2024-01-10", 3))
    return df.withColumn("updated_at", F.col("updated_at").cast(kind))


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz", "date"])
def test_time_watermark(spark, kind):
    assert values(filter_incremental(times(spark, kind), "updated_at", "2024-01-04"), "v") == [2, 3]
    assert values(filter_incremental(times(spark, kind), "updated_at", "2024-01-05"), "v") == [3]


def test_no_watermark_or_column_keeps_all(spark):
    assert filter_incremental(times(spark), "updated_at", None).count() == 3
    assert filter_incremental(times(spark), "nope", "2024-01-04").count() == 3


def test_grace_readmits_late_rows(spark):
    df = frame(spark, "t string", ("2024-01-04T23:59:00",))
    assert filter_incremental(df, "t", "2024-01-05T00:00:00").count() == 0
    assert filter_incremental(df, "t", "2024-01-05T00:00:00", 3600).count() == 1


def test_date_column_with_grace(spark):
    df = times(spark, "date")
    assert values(filter_incremental(df, "updated_at", "2024-01-05 12:00:00", 3600 * 12), "v") == [3]
    assert values(filter_incremental(df, "updated_at", "2024-01-05 12:00:00", 3600 * 12 + 1), "v") == [2, 3]


def test_text_watermark_ignores_grace(spark):
    df = frame(spark, "seq string, v int", ("a1", 1), ("a2", 2), ("a3", 3))
    assert watermark_kind(df, "seq", "a1") == "text"
    assert values(filter_incremental(df, "seq", "a1", 99), "v") == [2, 3]


def test_time_like_watermark_on_text_column_compares_as_text(spark):
    df = frame(spark, "seq string, v int", ("a1", 1), ("1999", 2))
    assert watermark_kind(frame(spark, "seq string", ("a1",), ("b",)), "seq", "2024-01-01") == "text"
    assert watermark_kind(df, "seq", "2024-01-01") == "time"


def test_number_watermark_compares_as_number(spark):
    """D20: "9" must not drop 10 and 11."""
    df = frame(spark, "id bigint, x double, d decimal(10,2)", (9, 9.5, None), (10, 10.5, None), (11, 11.5, None))
    assert values(filter_incremental(df, "id", "9"), "id") == [10, 11]
    assert values(filter_incremental(df, "id", "9.5"), "id") == [10, 11]
    assert values(filter_incremental(df, "x", "9.5"), "id") == [10, 11]


def test_unparseable_times_drop_out(spark):
    """D21."""
    df = frame(spark, "t string", ("2024-01-02",), ("soon",), (None,))
    assert filter_incremental(df, "t", "2024-01-01").count() == 1


def test_compute_and_advance_watermark(spark):
    df = times(spark)
    assert compute_watermark(df, "updated_at") == "2024-01-10"
    assert compute_watermark(df.filter("v > 9"), "updated_at") is None
    assert compute_watermark(df, "nope") is None
    t = df.schema["updated_at"].dataType
    assert advance_watermark(spark, "2024-02-01", "2024-01-10", t, "time") == "2024-02-01"
    assert advance_watermark(spark, "9", "10", t, "number") == "10"
    assert advance_watermark(spark, "a9", None, t, "text") == "a9"
    assert advance_watermark(spark, None, "a1", t, "text") == "a1"


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    times(spark, "timestamp").write.parquet(str(tmp_path / "t"))
    df = filter_incremental(spark.read.parquet(str(tmp_path / "t")), "updated_at", "2024-01-04", 60)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan.split("PushedFilters")[1]


# cleaning

def test_trim_and_lower(spark):
    df = frame(spark, "email string", ("  Ada@Example.com  ",), ("grace@example.com",))
    spec = {"trim": ["email"], "lowercase": ["email"]}
    assert values(clean(df, spec), "email") == ["ada@example.com", "grace@example.com"]
    s = clean_stats(df, spec).first()
    assert (s.cells_trimmed, s.cells_lowercased, s.cells_filled, s.rows_dropped) == (1, 1, 0, 0)


def test_blank_becomes_missing(spark):
    df = frame(spark, "c string", ("US",), ("   ",), ("",))
    assert [r.c for r in clean(df, {"trim": ["c"]}).collect()] == ["US", None, None]
    assert clean_stats(df, {"trim": ["c"]}).first().cells_trimmed == 1


def test_null_cells_are_not_counted_as_trimmed(spark):
    """D5."""
    df = frame(spark, "c string", (" a",), (None,))
    assert clean_stats(df, {"trim": ["c"], "lowercase": ["c"]}).first().cells_trimmed == 1


def test_trim_covers_unicode_space(spark):
    """D7."""
    cell = WHITESPACE + "a b" + WHITESPACE
    assert frame(spark, "c string", (cell,)).select(strip(F.col("c"))).first()[0] == cell.strip() == "a b"


def test_trim_on_a_number_does_nothing(spark):
    """D6."""
    df = frame(spark, "n bigint", (1,))
    assert clean(df, {"trim": ["n"], "lowercase": ["n", "nope"]}).first().n == 1


def test_fill(spark):
    df = frame(spark, "c string, n bigint, x double", ("US", None, float("nan")), (None, 1, None))
    spec = {"fill_null": {"c": "UNKNOWN", "n": 0, "x": 1.5}}
    assert [tuple(r) for r in clean(df, spec).collect()] == [("US", 0, 1.5), ("UNKNOWN", 1, 1.5)]
    assert clean_stats(df, spec).first().cells_filled == 4
    mixed = clean(df, {"fill_null": {"n": "none"}})
    assert dict(mixed.dtypes)["n"] == "string" and values(mixed, "n") == ["1", "none"]
    assert dict(clean(df, {"fill_null": {"n": 0.5}}).dtypes)["n"] == "double"


def test_drop_rules(spark):
    df = frame(spark, "email string", ("a@x.com",), (None,), ("c@x.com",))
    assert clean(df, {"drop_rows_missing": ["email", "nope"]}).count() == 2
    wide = frame(spark, "a string, b string, c string", ("1", "2", "3"), (None, None, None), ("4", None, "5"))
    assert clean(wide, {"min_present_fraction": 0.5}).count() == 2
    assert clean_stats(wide, {"min_present_fraction": 0.5}).first().rows_dropped == 1
    assert clean(wide, {"min_present_fraction": 0.1}).count() == 3


def test_observed_cleaning_counts_in_the_same_pass(spark):
    df = frame(spark, "email string, k int", (" A ", 1), (None, 2))
    seen = Observation()
    spec = {"trim": ["email"], "lowercase": ["email"], "drop_rows_missing": ["email"]}
    out = clean_observed(df, spec, seen)
    assert out.columns == ["email", "k"] and [tuple(r) for r in out.collect()] == [("a", 1)]
    got = seen.get
    assert (got["cells_trimmed"], got["cells_lowercased"], got["rows_dropped"], got["rows_delta"]) == (1, 1, 1, 2)


def test_nan_is_null(spark):
    """D1."""
    df = nan_to_null(frame(spark, "x double", (float("nan"),), (1.0,), (None,)))
    assert df.filter("x IS NULL").count() == 2


# reshaping

def test_rename_and_select(spark):
    df = frame(spark, "cust_id int, extra int", (1, 2))
    assert transform(df, {"rename": {"cust_id": "customer_id"}, "select": ["customer_id"]}).columns == ["customer_id"]
    with pytest.raises(TransformError, match="nope"):
        transform(df, {"select": ["cust_id", "nope"]})
    assert transform(df, {"rename": {"zz": "y"}, "select": []}).columns == ["cust_id", "extra"]


def test_cast(spark):
    df = frame(spark, "a string, b int", ("1", 2), (None, None))
    assert [tuple(r) for r in transform(df, {"cast": {"a": "int", "b": "str"}}).collect()] == [(1, "2"), (None, None)]
    with pytest.raises(TransformError):
        transform(df, {"cast": {"nope": "int"}})
    with pytest.raises(TransformError):
        transform(df, {"cast": {"a": "complex"}})
    with pytest.raises(PySparkException):
        transform(frame(spark, "a string", ("x",)), {"cast": {"a": "int"}}).collect()


def test_keep_first_runs_after_rename_and_cast(spark):
    """D26."""
    df = frame(spark, "k string, v int, t int", ("1", 10, 2), ("01", 20, 1), ("2", 30, 3))
    spec = {"rename": {"k": "key"}, "cast": {"key": "int"}, "drop_duplicates": ["key"], "select": ["v"]}
    assert values(transform(df, spec, [F.col("t")]), "v") == [20, 30]


def test_keep_first_cuts_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = dedupe_keep_first(df, ["k"], [F.col("t")])._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


# scalar functions

def test_mask_email(spark):
    df = frame(spark, "e string", ("ada@example.com",), ("@x.com",), ("plain",), ("",), ("a@",), ("a@b@c",), (None,))
    got = [r[0] for r in df.select(mask_email(F.col("e"))).collect()]
    assert got == ["a***@example.com", "@x.com", "p***", "", "a***", "a***@b@c", None]
    assert df.select(mask_email(F.col("e"), privileged=True)).first()[0] == "ada@example.com"


def test_parse_number(spark):
    texts = [" 5 ", "1d", "0x1A", "1_000", "inf", "-Infinity", "nan", "", "1e5", ".5", "5.", "+3", "True", None]
    df = frame(spark, "s string", *[(t,) for t in texts])
    got = [r[0] for r in df.select(parse_number(F.col("s"), df.schema["s"].dataType)).collect()]
    inf = float("inf")
    assert got == [5.0, None, None, None, inf, -inf, None, None, 1e5, 0.5, 5.0, 3.0, None, None]
    ts = frame(spark, "t timestamp", (datetime(2024, 1, 1),))
    assert ts.select(parse_number(F.col("t"), ts.schema["t"].dataType)).first()[0] is None


def test_all_null_column_keeps_the_old_watermark(spark):
    """D23."""
    df = frame(spark, "t timestamp", (None,))
    assert compute_watermark(df, "t") is None
    assert advance_watermark(spark, "2024-01-01", None, df.schema["t"].dataType, "time") == "2024-01-01"
