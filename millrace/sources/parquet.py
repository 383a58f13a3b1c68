"""Parquet tables, the native format between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import ExtractError


def read_parquet(spark: SparkSession, config: dict) -> DataFrame:
    """Config: ``{"path": ..., "merge_schema": False}``."""
    if not config.get("path"):
        raise ExtractError("a parquet source needs a 'path'")
    merge = str(bool(config.get("merge_schema"))).lower()
    return spark.read.option("mergeSchema", merge).parquet(config["path"])
