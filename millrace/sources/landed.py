"""Landed JSON pages as a Spark data source of their own: ``spark.read.format("landed_pages")``.

A page is one file whose name ends in its number, as in :mod:`millrace.sources.pages`, but here files are the
partitions: each task opens its own pages, filters on ``page`` (and on the path's ``dt=`` folder, as text) are
taken over before any file is opened, and a stream picks up pages as their numbers grow. Rows have the fields
of the given schema besides ``page``, ``dt`` and ``at``, the record's place in its page; what a record lacks, and
what does not fit its column, is NULL. Unlike the checked reader this one takes each page by itself: gaps and
empty pages are nothing special, but a page without a list of records is an error.

Files are listed and opened through pyarrow's file systems (local paths, ``file:``, ``s3:``, ``hdfs:``).
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, LessThan, LessThanOrEqual,
)

from millrace.session import ship_package

NAME = "landed_pages"
PLACE = "page bigint, dt string, at bigint"
_NUMBER = re.compile(r"(\d+)[^0-9/]*$")
_DAY = re.compile(r"(?:^|/)dt=([^/]+)/")
_PUSHDOWN = "spark.sql.python.filterPushdown.enabled"

_TESTS = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b,
    LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, In: lambda a, b: a in b,
}


@dataclass(frozen=True)
class PageFile(InputPartition):
    path: str
    page: int
    dt: str | None


def _file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:") and not path.startswith("file://"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def page_files(path: str) -> list[PageFile]:
    """The pages below a folder, by number."""
    from pyarrow import fs

    system, root = _file_system(path)
    found = []
    for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
        number, day = _NUMBER.search(info.path), _DAY.search(info.path)
        hidden = any(part.startswith((".", "_")) for part in info.path[len(root) :].split("/"))
        if info.type == fs.FileType.File and number and not hidden:
            found.append(PageFile(info.path, int(number[1]), day and day[1]))
    return sorted(found, key=lambda f: (f.page, f.path))


def _fitting(value, dtype: T.DataType):
    """A JSON value as a column's type, NULL where it does not fit."""
    if value is None:
        return None
    if isinstance(dtype, T.StringType):
        return value if isinstance(value, str) else json.dumps(value, separators=(",", ":"), ensure_ascii=False)
    if isinstance(dtype, T.BooleanType):
        return value if isinstance(value, bool) else None
    if isinstance(dtype, T.IntegralType):
        bits = {"byte": 8, "short": 16, "integer": 32}.get(dtype.typeName(), 64)
        return value if type(value) is int and -(2 ** (bits - 1)) <= value < 2 ** (bits - 1) else None
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return float(value) if type(value) in (int, float) else None
    if isinstance(dtype, T.ArrayType):
        return [_fitting(v, dtype.elementType) for v in value] if isinstance(value, list) else None
    if isinstance(dtype, T.StructType):
        return tuple(_fitting(value.get(f.name), f.dataType) for f in dtype) if isinstance(value, dict) else None
    raise TypeError(f"{NAME} has no columns of type {dtype.simpleString()}")


def _rows(file: PageFile, root: str, results_path: str | None, schema: T.StructType) -> Iterator[tuple]:
    with _file_system(root)[0].open_input_stream(file.path) as stream:
        document = json.loads(stream.read())
    records = document.get(results_path) if results_path and isinstance(document, dict) else document
    if not isinstance(records, list):
        raise ValueError(f"page {file.page} ({file.path}) holds no list of records")
    place = {"page": file.page, "dt": file.dt}
    for at, record in enumerate(records):
        fields = record if isinstance(record, dict) else {}
        known = {**place, "at": at}
        yield tuple(known[f.name] if f.name in known else _fitting(fields.get(f.name), f.dataType) for f in schema)


class PageReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.root, self.results = schema, options["path"], options.get("results_path")
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take over what tells of pages or days; the rest stays with Spark."""
        for given in filters:
            if type(given) in _TESTS and given.attribute in (("page",), ("dt",)):
                self.filters.append(given)
            else:
                yield given

    def _wanted(self, file: PageFile) -> bool:
        for f in self.filters:
            value = getattr(file, f.attribute[0])
            if value is None or not _TESTS[type(f)](value, f.value):
                return False
        return True

    def partitions(self) -> list[PageFile]:
        return [f for f in page_files(self.root) if self._wanted(f)]

    def read(self, partition: PageFile | None) -> Iterator[tuple]:
        if partition is not None:  # Spark reads one empty partition where no file is wanted
            yield from _rows(partition, self.root, self.results, self.schema)


class PageStreamReader(DataSourceStreamReader):
    """Pages in the order of their numbers; an offset is the number of the last page that was taken."""

    def __init__(self, schema: T.StructType, options: dict):
        self.schema, self.root, self.results = schema, options["path"], options.get("results_path")

    def initialOffset(self) -> dict:
        return {"page": -1}

    def latestOffset(self) -> dict:
        return {"page": max((f.page for f in page_files(self.root)), default=-1)}

    def partitions(self, start: dict, end: dict) -> list[PageFile]:
        return [f for f in page_files(self.root) if start["page"] < f.page <= end["page"]]

    def read(self, partition: PageFile) -> Iterator[tuple]:
        yield from _rows(partition, self.root, self.results, self.schema)

    def commit(self, end: dict) -> None:
        """Landed files stay."""


class LandedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return f"{PLACE}, record string"

    def reader(self, schema: T.StructType) -> PageReader:
        return PageReader(schema, self.options)

    def streamReader(self, schema: T.StructType) -> PageStreamReader:
        return PageStreamReader(schema, self.options)


def install(spark: SparkSession) -> None:
    """Make the format known to a session, with filters handed to it."""
    ship_package(spark)
    spark.dataSource.register(LandedPages)
    spark.conf.set(_PUSHDOWN, "true")


def read_landed(spark: SparkSession, config: dict):
    """The ``landed_pages`` source type: ``{"path": .., "schema": <DDL of a record>, "results_path": None}``."""
    install(spark)
    reader = spark.read.format(NAME).schema(f"{PLACE}, {config['schema']}")
    if config.get("results_path"):
        reader = reader.option("results_path", config["results_path"])
    return reader.load(config["path"])
