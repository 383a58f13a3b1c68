"""Landed pages as a data source: partitions, pushed filters, streams."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull
from pyspark.sql.types import StructType

from millrace.sources import POSITION, extract
from millrace.sources.landed import PLACE, LandedPages, PageReader, install, page_files

RECORD = "id bigint, name string, share double, ok boolean, tags array<string>, box struct<x: int, y: string>"


@pytest.fixture
def landed(tmp_path):
    for page in range(1, 9):
        folder = tmp_path / f"dt=2024-01-0{(page + 1) // 2}"
        folder.mkdir(exist_ok=True)
        rows = [
            {"id": 10 * page + i, "name": f"n{i}", "share": i / 4 if i else 1, "ok": i == 1, "tags": ["a", "b"][:i], "box": {"x": i, "y": "z"}}
            for i in range(3)
        ]
        (folder / f"page-{page:03d}.json").write_text(json.dumps(rows))
    (tmp_path / "dt=2024-01-01" / ".page-009.json").write_text("hidden")
    return str(tmp_path)


def test_equals_the_file_reader(spark, landed):
    found = extract(spark, "landed_pages", {"path": landed, "schema": RECORD})
    wanted = extract(spark, "rest_api", {"path": f"{landed}/*/page-*.json", "schema": RECORD}).drop(POSITION)
    assert found.columns == ["page", "dt", "at", *wanted.columns] and found.rdd.getNumPartitions() == 8
    as_text = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert as_text(found.drop("page", "dt", "at")) == as_text(wanted) and found.count() == 24


def test_filters_reach_the_source(spark, landed):
    reader = PageReader(StructType.fromDDL(f"{PLACE}, id bigint"), {"path": landed})
    left = list(reader.pushFilters([GreaterThan(("page",), 2), EqualTo(("id",), 31), In(("dt",), ("2024-01-02", "2024-01-09")), IsNotNull(("page",))]))
    assert [type(f) for f in left] == [EqualTo, IsNotNull] and len(reader.filters) == 2
    assert [f.page for f in reader.partitions()] == [3, 4]
    found = extract(spark, "landed_pages", {"path": landed, "schema": RECORD})
    for condition, pages in (("page > 6", {7, 8}), ("page IN (2, 5) AND id % 10 = 1", {2, 5}), ("dt = '2024-01-03' AND page <= 5", {5}), ("page = 99", set())):
        narrowed = found.filter(condition)
        assert narrowed.rdd.getNumPartitions() == max(len(pages), 1) and {r.page for r in narrowed.collect()} == pages


def test_values_that_do_not_fit_are_null(spark, tmp_path):
    rows = [{"id": "x", "name": {"a": [1]}, "share": "1", "ok": 1, "tags": "no", "box": {"x": 2**40}}, 5, {"id": 2**70, "name": True, "share": 2}]
    (tmp_path / "1.json").write_text(json.dumps({"data": rows}))
    found = extract(spark, "landed_pages", {"path": str(tmp_path), "schema": RECORD, "results_path": "data"})
    got = [(r.id, r.name, r.share, r.ok, r.tags, r.box and tuple(r.box)) for r in found.orderBy("at").collect()]
    assert got == [(None, '{"a":[1]}', None, None, None, (None, None)), (None,) * 6, (None, "true", 2.0, None, None, None)]
    (tmp_path / "2.json").write_text('{"data": 5}')
    found = extract(spark, "landed_pages", {"path": str(tmp_path), "schema": RECORD, "results_path": "data"})
    with pytest.raises(Exception, match="no list of records"):
        found.collect()
    assert found.filter("page < 2").count() == 3
    assert page_files(str(tmp_path))[0].dt is None and page_files(f"file:{tmp_path}") == page_files(f"file://{tmp_path}") and LandedPages({}).name() == "landed_pages"


def test_a_stream_takes_each_page_once(spark, landed, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    install(spark)

    def poll():
        stream = spark.readStream.format("landed_pages").schema(f"{PLACE}, {RECORD}").load(landed)
        stream.writeStream.format("parquet").option("checkpointLocation", f"{out}/cp").trigger(availableNow=True).start(f"{out}/rows").awaitTermination()
        return spark.read.parquet(f"{out}/rows").groupBy("page").agg(F.count("id").alias("n")).collect()

    assert {(r.page, r.n) for r in poll()} == {(p, 3) for p in range(1, 9)}
    with open(f"{landed}/page-012.json", "w") as f:
        f.write('[{"id": 1}]')
    assert {(r.page, r.n) for r in poll()} == {(p, 3) for p in range(1, 9)} | {(12, 1)}
