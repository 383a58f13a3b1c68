"""Rules that cannot be computed, rows set aside, and their replay."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.errors import EtlError, LoadError, ValidationFailed
from millrace.lake import targets
from millrace.lake.state import State
from millrace.operators import rules as R
from millrace.operators.quarantine import BROKEN, DIGEST, ORIGIN, corrected
from millrace.plans import ingest
from millrace.plans.ingest import PipelineSpec, run_ingest
from millrace.plans.replay import pending, quarantined, replay

DAY, LATER = datetime(2024, 5, 1), datetime(2024, 6, 1)
HUGE = 9223372036854775807


def broken(df, *expressions):
    specs = [{"type": "business_rule", "name": e, "expression": e} for e in expressions]
    return [r.violation_count for r in R.rule_results(df, specs).orderBy("position").collect()]


@pytest.mark.parametrize("strict", ["true", "false"])
@pytest.mark.parametrize("codegen", [True, False])
def test_rules_that_overflow_are_broken(spark, strict, codegen):
    before = {k: spark.conf.get(k) for k in ("spark.sql.ansi.enabled", "spark.sql.codegen.wholeStage", "spark.sql.codegen.factoryMode")}
    spark.conf.set("spark.sql.ansi.enabled", strict)
    if codegen:
        spark.conf.set("spark.sql.codegen.wholeStage", "true")
        spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        df = spark.createDataFrame([(HUGE, 0, "n.a."), (5, 2, "7"), (None, 1, "3"), (-HUGE - 1, 3, "x")], "x bigint, q int, age string")
        df = df.repartition(2)
        assert broken(
            df, "x + 1 < 0", "cast(x as tinyint) = -1", "x + 1 > 0", "x + 1 > 0 and q > 0", "x / q > 1", "age > 3", "-x < 0", "abs(x) > 0",
            "x * 2 <> 0", "x % q >= 0", "x div q >= 0", "element_at(array(1, 2), q) = 2", "smallint(x) = 5", "q in (0, 1, 2, 3)", "x + 1 > 0 -- note",
        ) == [3, 4, 3, 3, 3, 3, 2, 2, 3, 3, 3, 3, 3, 0, 3]
        assert spark.conf.get("spark.sql.ansi.enabled") == strict
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def customers(spark, path, rows):
    spark.createDataFrame(rows, "id int, mail string, age int").write.mode("overwrite").parquet(path)
    return PipelineSpec(
        "p", {"type": "parquet", "path": path}, target="customers", quarantine=True, order_by=["customer_id", "age"],
        transform={"rename": {"id": "customer_id", "mail": "email"}},
        validation={"rules": [
            {"type": "not_null", "columns": ["mail"]}, {"type": "range", "column": "age", "min": 18},
            {"type": "range", "column": "age", "max": 50, "severity": "warning"},
        ]},
    )


ROWS = [(1, "a", 20), (2, None, 30), (3, "c", 10), (4, None, 5), (5, "e", 60), (6, "f", None), (3, "c", 10)]


def gold(spark, lake):
    return sorted((r.external_id, r.email) for r in targets.open_dimension(spark, lake, "customers").current().collect())


def ids(rows):
    return sorted((r.id, tuple(r[BROKEN]), r[ORIGIN]) for r in rows.collect())


def test_rows_that_break_rules_are_set_aside(spark, tmp_path, lake):
    spec = customers(spark, str(tmp_path / "in"), ROWS)
    result = run_ingest(spark, lake, spec, "007", DAY)
    assert (result.rows_extracted, result.rows_loaded, result.rows_quarantined) == (7, 3, 4)
    assert gold(spark, lake) == [("1", "a"), ("5", "e"), ("6", "f")]
    assert ids(quarantined(spark, lake, "customers")) == [
        (2, ("not_null",), "007"), (3, ("range",), "007"), (3, ("range",), "007"), (4, ("not_null", "range"), "007"),
    ]
    run = State(spark, lake).runs().first()
    assert run.metrics["rows_quarantined"] == 4.0 and run.status == "SUCCEEDED"
    assert not State(spark, lake).read("scorecards").first().passed


def test_without_broken_rows_nothing_is_set_aside(spark, tmp_path, lake):
    spec = customers(spark, str(tmp_path / "in"), ROWS[:1])
    assert run_ingest(spark, lake, spec, "r1", DAY).rows_quarantined == 0
    assert quarantined(spark, lake, "customers") is None and pending(spark, lake, "customers") is None
    with pytest.raises(EtlError, match="set aside"):
        replay(spark, lake, spec, spark.createDataFrame([("x",)], f"{DIGEST} string"), "r2")


def test_only_broken_rows_load_nothing(spark, tmp_path, lake):
    spec = customers(spark, str(tmp_path / "in"), [(2, None, 30)])
    result = run_ingest(spark, lake, spec, "r1", DAY)
    assert (result.rows_loaded, result.rows_quarantined, gold(spark, lake)) == (0, 1, [])


def test_rules_that_compare_rows_still_block(spark, tmp_path, lake):
    spec = customers(spark, str(tmp_path / "in"), ROWS)
    spec.validation["rules"].append({"type": "unique", "columns": ["id"]})
    with pytest.raises(ValidationFailed, match="repeated"):
        run_ingest(spark, lake, spec, "r1", DAY)
    assert quarantined(spark, lake, "customers") is None and gold(spark, lake) == []


def fixes(spark, lake, wanted):
    rows = pending(spark, lake, "customers").select("id", DIGEST).distinct()
    return rows.join(spark.createDataFrame(wanted, "id int, mail string, age int"), "id").drop("id")


def test_replayed_rows_load_once(spark, tmp_path, lake):
    spec = customers(spark, str(tmp_path / "in"), ROWS)
    run_ingest(spark, lake, spec, "r1", DAY)
    first = replay(spark, lake, spec, fixes(spark, lake, [(2, "b", 30), (3, "c", 11)]), "r2", LATER)
    assert (first.rows_extracted, first.rows_loaded, first.rows_quarantined) == (3, 1, 2)
    assert ids(pending(spark, lake, "customers")) == [(3, ("range",), "r2"), (3, ("range",), "r2"), (4, ("not_null", "range"), "r1")]
    # the same corrections again find nothing that waits for them
    taken = quarantined(spark, lake, "customers").filter("id = 2").select(DIGEST, F.lit("again").alias("mail"))
    assert replay(spark, lake, spec, taken, "r3", LATER).rows_extracted == 0
    last = replay(spark, lake, spec, fixes(spark, lake, [(3, "c", 33), (4, "d", 44)]), "r4", LATER)
    assert (last.rows_loaded, last.rows_quarantined) == (3, 0)
    assert gold(spark, lake) == [("1", "a"), ("2", "b"), ("3", "c"), ("4", "d"), ("5", "e"), ("6", "f")]
    assert pending(spark, lake, "customers").count() == 0


def test_a_replay_that_fails_gives_its_rows_back_and_one_that_dies_goes_on(spark, tmp_path, lake, monkeypatch):
    spec = customers(spark, str(tmp_path / "in"), ROWS)
    run_ingest(spark, lake, spec, "r1", DAY)

    def refuse(*args, **kwargs):
        raise LoadError("no")

    with monkeypatch.context() as patch:
        patch.setattr("millrace.lake.targets.load", refuse)
        with pytest.raises(LoadError):
            replay(spark, lake, spec, fixes(spark, lake, [(2, "b", 30)]), "r2", LATER)
    assert pending(spark, lake, "customers").count() == 4

    class Killed(BaseException):
        pass

    def die(*args):
        raise Killed

    wanted = fixes(spark, lake, [(2, "b", 30)])
    with monkeypatch.context() as patch:
        patch.setattr(ingest.IngestRun, "record", die)
        with pytest.raises(Killed):
            replay(spark, lake, spec, wanted, "r3", LATER)
    assert pending(spark, lake, "customers").count() == 3
    result = replay(spark, lake, spec, spark.createDataFrame([], wanted.schema), "r3", LATER)
    assert result.load_result == {"created": 1, "updated": 0} and ("2", "b") in gold(spark, lake)


def test_corrections_have_to_fit(spark, tmp_path, lake):
    spec = customers(spark, str(tmp_path / "in"), ROWS)
    run_ingest(spark, lake, spec, "r1", DAY)
    two = fixes(spark, lake, [(2, "b", 30), (2, "x", 30)])
    with pytest.raises(EtlError, match="several"):
        replay(spark, lake, spec, two, "r2", LATER)
    rows = pending(spark, lake, "customers")
    with pytest.raises(ValueError, match="nowhere"):
        corrected(rows, rows.select(DIGEST, F.lit(1).alias("nowhere")))
    some = corrected(rows, rows.filter("id = 2").select(DIGEST, F.lit("31").alias("age"))).collect()
    assert [(r.id, r.mail, r.age) for r in some] == [(2, None, 31)]
