"""As-of join against a search row by row."""

import random
from datetime import datetime, timedelta

import pytest

from millrace.operators.asof import asof_join

START = datetime(2024, 1, 1)


def tables(seed, n):
    rnd = random.Random(seed)
    when = lambda: None if rnd.random() < 0.03 else START + timedelta(minutes=rnd.randint(0, 300))
    key = lambda: rnd.choice([None, "hot", "hot", "hot", "a", "b", "c", "d"])
    left = [(key(), when(), i % 40) for i in range(n)]
    right = [(key(), when(), rnd.choice([None, 1, 2, 3]), f"v{rnd.randint(0, 5)}") for _ in range(n // 3)]
    return left, right


def plain(left, right, exact, most):
    out = []
    for key, at, i in left:
        fits = [
            r for r in right
            if key is not None and at is not None and r[0] == key and r[1] is not None and (r[1] < at or (exact and r[1] == at))
        ]
        best = max(fits, key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3]), default=None)
        if best and most is not None and (at - best[1]).total_seconds() > most:
            best = None
        out.append((key, at, i, *(best[1:] if best else (None, None, None))))
    return sorted(map(str, out))


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("most", [None, 600])
@pytest.mark.parametrize("hot_key_rows", [None, 1_000_000, 20])
def test_equals_a_search_row_by_row(spark, exact, most, hot_key_rows):
    left, right = tables(7, 400)
    a = spark.createDataFrame(left, "k string, at timestamp, i int")
    b = spark.createDataFrame(right, "k string, seen timestamp, n int, v string")
    found = asof_join(a, b, ["k"], "at", "seen", exact=exact, most_seconds=most, hot_key_rows=hot_key_rows)
    assert found.columns == ["k", "at", "i", "seen", "n", "v"]
    assert sorted(str(tuple(r)) for r in found.collect()) == plain(left, right, exact, most)


def test_numbers_several_keys_and_empty_tables(spark):
    a = spark.createDataFrame([(1, "x", 5), (1, "y", 5), (2, "x", 1)], "k int, l string, t int")
    b = spark.createDataFrame([(1, "x", 4, "p"), (1, "x", 5, "q"), (2, "x", 1, "r")], "k int, l string, u int, v string")
    assert sorted(r.v or "-" for r in asof_join(a, b, ["k", "l"], "t", "u").collect()) == ["-", "-", "p"]
    assert sorted(r.v or "-" for r in asof_join(a, b, ["k", "l"], "t", "u", exact=True).collect()) == ["-", "q", "r"]
    assert [r.v for r in asof_join(a, b.limit(0), ["k", "l"], "t", "u").collect()] == [None] * 3
    assert asof_join(a.limit(0), b, ["k", "l"], "t", "u").collect() == []
    with pytest.raises(ValueError, match="both tables"):
        asof_join(a, a, ["k"], "t", "t")


def test_each_table_is_shuffled_once(spark):
    a, b = (spark.range(1000).selectExpr("id % 10 k", f"id {c}") for c in ("t", "u"))
    plan = asof_join(a, b, ["k"], "t", "u", hot_key_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
