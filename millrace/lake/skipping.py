"""File skipping: what each file of a layer holds, so that incremental reads open only files with new rows.

Next to a layer lies an index, one small file per run: per data file its rows, and the smallest and largest
value of some columns. A read of rows past a watermark asks the index first and hands Spark only the files
whose largest value lies past it; rows are filtered all the same, so the index can only save work. A run's
entry goes before its files are written and comes after, so it never tells of files that are not there; the
files of a run without an entry are all read.

Times are compared to the microsecond, numbers as doubles and texts by their first characters, all of which
keep the order, so a file is skipped only if none of its rows can pass. Texts that read as times have times.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import timedelta
from decimal import Decimal
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ExtractError
from millrace.functions.times import parse_time
from millrace.functions.types import is_text, quoted
from millrace.lake import files
from millrace.lake.layers import index_dir, layer_dir
from millrace.operators.incremental import newer_than, watermark_kind, watermark_time
from millrace.session import local_frame
from millrace.sources.registry import POSITION, register_source

# A text's first characters stand for it.
TEXT_HEAD = 64
# More files than that are named by their runs' folders.
MOST_FILES = 10_000
# Columns that are no data but names of folders.
PLACES = ("dt", "run_id")

_RANGE = "struct<min_time:timestamp,max_time:timestamp,min_number:double,max_number:double,min_text:string,max_text:string>"
SCHEMA = f"file string, rows bigint, columns string, ranges map<string,{_RANGE}>"


def default_columns(schema: T.StructType) -> list[str]:
    """Columns whose range is cheap to keep: times, dates and numbers."""
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType, T.NumericType)
    return [f.name for f in schema if isinstance(f.dataType, kinds)]


def _range(column: str, dtype: T.DataType) -> Column:
    col = F.col(quoted(column))
    values = {k: F.lit(None).cast(t) for k, t in (("time", "timestamp"), ("number", "double"), ("text", "string"))}
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        values["time"] = col.cast("timestamp")
    elif isinstance(dtype, T.NumericType):
        values["number"] = col.cast("double")
    elif is_text(dtype):
        values["text"], values["time"] = F.left(col, F.lit(TEXT_HEAD)), parse_time(col, dtype).cast("timestamp")
    return F.struct(*[f(v).alias(f"{n}_{k}") for k, v in values.items() for n, f in (("min", F.min), ("max", F.max))])


def _file() -> Column:
    """The data file's place below its layer's folder, with what the path's encoding hides put back."""
    tail = F.regexp_extract(F.col("_metadata.file_path"), "(dt=[^/]+/run_id=[^/]+/[^/]+)$", 1)
    return F.url_decode(F.replace(tail, F.lit("+"), F.lit("%2B")))


def index_run(
    spark: SparkSession, root: str, layer: str, dataset: str, run_id: str, columns: list[str] | None = None
) -> None:
    """Write the index of what a run wrote to a layer: one narrow scan of its files.

    Without ``columns``, times and numbers are indexed; texts have to be named.
    """
    base = layer_dir(root, layer, dataset)
    for folder in files.matches(spark, f"{base}/dt=*/run_id={run_id}"):
        if not files.names(spark, folder):
            continue
        rows = spark.read.parquet(folder)
        kept = [c for c in (default_columns(rows.schema) if columns is None else columns) if c in rows.columns and c != POSITION]
        ranges = [x for c in kept for x in (F.lit(c), F.col(f"r{kept.index(c)}"))]
        found = rows.groupBy(_file().alias("file")).agg(
            F.count(F.lit(1)).alias("rows"), *[_range(c, rows.schema[c].dataType).alias(f"r{i}") for i, c in enumerate(kept)]
        ).select(
            "file", "rows", F.lit(T.StructType([f for f in rows.schema if f.name != POSITION]).json()).alias("columns"),
            (F.create_map(*ranges) if ranges else F.create_map()).cast(f"map<string,{_RANGE}>").alias("ranges"),
        )
        day = folder.rstrip("/").rsplit("/", 2)[1]
        found.coalesce(1).write.mode("overwrite").parquet(f"{index_dir(root, layer, dataset)}/{day}/run_id={run_id}")


@dataclass(frozen=True)
class Bound:
    """A watermark as the index compares it."""

    kind: str
    value: object

    @classmethod
    def of(cls, spark: SparkSession, kind: str, watermark: str, grace_seconds: float) -> "Bound":
        if kind == "time":
            return cls(kind, str(watermark_time(spark, watermark) - timedelta(seconds=grace_seconds)))
        return cls(kind, float(Decimal(str(watermark))) if kind == "number" else str(watermark)[:TEXT_HEAD])

    def reached(self, ranges: Column, column: str) -> Column:
        """Whether a file whose ranges these are may have rows past the bound."""
        largest, limit = ranges[column][f"max_{self.kind}"], F.lit(self.value)
        # Doubles and first characters may be equal where the values are not.
        return largest > limit.cast("timestamp") if self.kind == "time" else largest >= limit


class IndexedLayer:
    """A layer of a dataset with its index."""

    def __init__(self, spark: SparkSession, root: str, layer: str, dataset: str):
        self.spark = spark
        self.base, self.index = layer_dir(root, layer, dataset), index_dir(root, layer, dataset)

    @cached_property
    def runs(self) -> set[str]:
        """``dt=../run_id=..`` of every run in the layer; folders only, no files are listed."""
        return {"/".join(f.rstrip("/").rsplit("/", 2)[1:]) for f in files.matches(self.spark, f"{self.base}/dt=*/run_id=*")}

    @cached_property
    def indexed(self) -> set[str]:
        done = files.matches(self.spark, f"{self.index}/dt=*/run_id=*/_SUCCESS")
        return {"/".join(f.rsplit("/", 3)[1:3]) for f in done} & self.runs

    @cached_property
    def entries(self) -> DataFrame:
        """One row per indexed file."""
        if not self.indexed:
            return local_frame(self.spark, [], SCHEMA)
        folders = [f"{self.index}/{run}" for run in sorted(self.indexed)]
        return self.spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(*folders)

    @cached_property
    def schema(self) -> T.StructType | None:
        """The columns of all runs, by the index alone; None if some run is not in it or types differ."""
        if self.runs != self.indexed or not self.runs:
            return None
        known: dict[str, T.StructField] = {}
        for row in self.entries.select("columns").distinct().collect():
            for f in T.StructType.fromJson(json.loads(row.columns)):
                if known.setdefault(f.name, f).dataType != f.dataType:
                    return None
        return T.StructType([*known.values(), T.StructField("dt", T.DateType()), T.StructField("run_id", T.StringType())])

    def _read(self, paths: list[str]) -> DataFrame:
        reader = self.spark.read.option("basePath", self.base)
        reader = reader.schema(self.schema) if self.schema else reader.option("mergeSchema", "true")
        return reader.parquet(*paths).drop(POSITION)

    def rows(self) -> DataFrame | None:
        """All rows with ``dt`` and ``run_id``; None without any run."""
        return self._read([self.base]) if self.runs else None

    def count(self) -> int:
        """Rows of the layer; only files that are not indexed are opened."""
        known = self.entries.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n")).first().n
        left = self._unindexed()
        return known + (self._read(left).count() if left else 0)

    def _unindexed(self) -> list[str]:
        return [f"{self.base}/{run}" for run in sorted(self.runs - self.indexed) if files.names(self.spark, f"{self.base}/{run}")]

    def kind(self, column: str, watermark: str, dtype: T.DataType) -> str:
        """How the column compares with the watermark; asks the index where it can."""
        if is_text(dtype) and not self._unindexed():
            if watermark_time(self.spark, watermark) is None:
                return "text"
            times = F.max(F.col("ranges")[column]["max_time"])
            lacking = F.count(F.when(~F.map_contains_key("ranges", F.lit(column)), 1))
            found = self.entries.agg(times.alias("t"), lacking.alias("n")).first()
            if not found.n:
                return "text" if found.t is None else "time"
        return watermark_kind(self.rows(), column, watermark)

    def paths_newer(self, column: str, bound: Bound) -> list[str]:
        """The files that may have rows past the bound; folders instead of very many files."""
        ranges = F.col("ranges")
        listed = F.map_contains_key(ranges, F.lit(column))
        has_column = F.contains(F.col("columns"), F.lit(f'"name":{json.dumps(column)}'))
        wanted = self.entries.filter(F.when(listed, bound.reached(ranges, column)).otherwise(has_column))
        found = [r.file for r in wanted.select("file").limit(MOST_FILES + 1).collect()]
        if len(found) > MOST_FILES:
            folders = wanted.select(F.substring_index("file", "/", 2).alias("run")).distinct()
            found = [r.run for r in folders.collect()]
        return [f"{self.base}/{f}" for f in sorted(found)] + self._unindexed()

    def newer(
        self, column: str, watermark: str, grace_seconds: float = 0, kind: str | None = None
    ) -> DataFrame | None:
        """The rows past the watermark, less the grace period; as a filter of all rows gives them."""
        everything = self.rows()
        if everything is None or column not in everything.columns:
            return everything
        kind = kind or self.kind(column, watermark, everything.schema[column].dataType)
        if column in PLACES:  # Spark skips folders by itself
            return everything.filter(newer_than(everything, column, watermark, grace_seconds, kind))
        paths = self.paths_newer(column, Bound.of(self.spark, kind, watermark, grace_seconds))
        if not paths:
            return local_frame(self.spark, [], everything.schema.toDDL())
        part = self._read(paths)
        lacking = [f for f in everything.schema if f.name not in part.columns]
        part = part.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking}) if lacking else part
        return part.select(*[F.col(quoted(c)) for c in everything.columns]).filter(
            newer_than(everything, column, watermark, grace_seconds, kind)
        )


def read_source(spark: SparkSession, config: dict) -> DataFrame:
    """The ``layer`` source: all rows of ``layer`` (silver unless given) of a ``dataset`` below ``root``."""
    rows = indexed_source(spark, config).rows()
    if rows is None:
        raise ExtractError(f"there is no {config.get('layer', 'silver')} layer of {config['dataset']!r}")
    return rows.drop(*PLACES)


def indexed_source(spark: SparkSession, config: dict) -> IndexedLayer:
    return IndexedLayer(spark, config["root"].rstrip("/"), config.get("layer", "silver"), config["dataset"])


register_source("layer", read_source)
