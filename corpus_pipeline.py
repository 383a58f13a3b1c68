"""From documents to training sequences: reject, identify, deduplicate, mix, pack.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of documents. Between stages rows are written as Parquet under the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard_join, language_id, mixing, packing, quality_rules
from millrace.llm.staging import staged
from millrace.session import ship_package

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
# Rows go to Python workers by their bytes: 10,000 whole texts at once stay in the memory of both sides.
BATCH_BYTES = 4 * 1024 * 1024


def _prepare(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or whose rule statistics are anomalous, go."""
    _prepare(spark)
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told go."""
    _prepare(spark)
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    _prepare(spark)
    return jaccard_join.one_of_each_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that fill the mixture's token budget, each at most once."""
    _prepare(spark)
    rows, chosen = mixing.mixed_rows(docs, mixing.document_keys(), max_epochs=1)
    return rows.select(*[f"`{c}`" for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    _prepare(spark)
    return packing.packed(docs, TOKENIZER)


STAGES = [("quality", quality), ("language", language), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

# The forest, the fused posterior and the tokenizer are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents table."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = stage(spark, rows, sf_dir)
        if name != STAGES[-1][0]:
            rows = staged(rows, name)
    return rows
