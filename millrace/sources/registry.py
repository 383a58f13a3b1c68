"""Source types by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from millrace.errors import EtlError, ExtractError, first_line

# Hidden struct column with a row's place in its source, for operators that keep the first or the
# last of several rows. Only readers of ordered files add it.
POSITION = "_pos"

Reader = Callable[[SparkSession, dict], DataFrame]
_READERS: dict[str, Reader] = {}


def register_source(name: str, reader: Reader) -> None:
    """Make ``reader(spark, config)`` available as a source type.

    A custom format written as a ``pyspark.sql.datasource.DataSource`` plugs in as
    ``lambda spark, config: spark.read.format(...).options(...).load()``.
    """
    _READERS[name.lower()] = reader


def source_types() -> list[str]:
    _install()
    return sorted(_READERS)


def extract(spark: SparkSession, source_type: str | None, config: dict) -> DataFrame:
    _install()
    reader = _READERS.get((source_type or "").lower())
    if reader is None:
        raise ExtractError(f"no reader for source type {source_type!r}; known: {sorted(_READERS)}")
    try:
        return reader(spark, config)
    except EtlError:
        raise
    except PySparkException as exc:
        raise ExtractError(f"{source_type} source: {first_line(exc)}") from exc


def _install() -> None:
    if "file" in _READERS:
        return
    from millrace.sources import csv, jdbc, landed, objects, pages, parquet

    _READERS.setdefault("file", csv.read_file)
    _READERS.setdefault("parquet", parquet.read_parquet)
    _READERS.setdefault("postgres", jdbc.read_jdbc)
    _READERS.setdefault("jdbc", jdbc.read_jdbc)
    _READERS.setdefault("s3", objects.read_object)
    _READERS.setdefault("rest_api", pages.read_landed_pages)
    _READERS.setdefault(landed.NAME, landed.read_landed)
