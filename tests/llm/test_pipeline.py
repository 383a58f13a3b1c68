"""The pipeline against the same stages done by hand."""

import corpus_pipeline
import pytest
from millrace.llm import queries

from test_corpus_operators import FOLDER, groups_by_brute_force, packing_holds


def test_each_stage_keeps_columns_and_takes_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = [tuple(r) for r in before.select("doc_id", "text").collect()]
        if name != "pack":
            assert docs.columns == before.columns and 0 < docs.count() <= before.count()
            assert docs.exceptAll(before).count() == 0
    groups = groups_by_brute_force(kept["near_duplicates"])
    assert sorted(d for d, _ in kept["mix"]) == sorted(d for d, _, c in groups if d == c)
    packing_holds(docs.collect(), kept["pack"])
    whole = corpus_pipeline.run(spark, FOLDER)
    assert {(r.doc_id, r.start) for r in whole.collect()} != set() and whole.columns == docs.columns


def test_empty_and_odd_documents(spark, make_docs):
    for docs in (make_docs([]), make_docs([(1, None), (None, "x"), (2, ""), (2, "")]), make_docs([(None, None, None, None)])):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, FOLDER).count() >= 0, name


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in queries.QUERIES.items() if sql))
def test_query_equals_its_sql(spark, name):
    import duckdb

    build, sql = queries.QUERIES[name]
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    found = build(spark, FOLDER)
    wanted = con.execute(f"SELECT {', '.join(found.columns)} FROM ({sql})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_registered_names():
    import __spark_entry__ as registered

    names = set(registered.queries())
    assert set(queries.QUERIES) <= names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(registered.oracle_sql()) >= {"op2_hamming_search", "op4_chat_trees", "op7_mixing"}


def test_stages_hand_texts_to_workers_by_their_bytes(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(setting)
    docs = spark.createDataFrame([(1, "a b c " * 200_000), (2, None), (3, "d")], "doc_id bigint, text string")
    for name, stage in corpus_pipeline.STAGES:
        if name == "pack":
            found = {r.doc_id: r.doc_tokens for r in stage(spark, docs, "").select("doc_id", "doc_tokens").distinct().collect()}
            assert set(found) == {1, 2, 3} and found[2] == 1
    assert int(spark.conf.get(setting)) == corpus_pipeline.BATCH_BYTES
