"""CSV with a header row, inferred types and strict field counts."""

from __future__ import annotations

import os
import re
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.errors import ExtractError, first_line
from millrace.functions.numbers import DECIMAL_PATTERN, INFINITY_PATTERN, INTEGER_PATTERN
from millrace.functions.types import quoted
from millrace.sources.registry import POSITION

# Texts that mean "missing" in a CSV cell.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Texts that mean true or false.
BOOLEAN_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")
SURPLUS = "_extra"
OPEN_QUOTE = "_open"
HEADER = "_header"
PLACE = "_place"


def resolve_path(path: str, base_dir: str | None) -> str:
    """Relative paths live under ``base_dir``; URIs and absolute paths stay as they are."""
    if base_dir is None or urlparse(path).scheme or os.path.isabs(path):
        return path
    return f"{base_dir.rstrip('/')}/{path}"


def read_file(spark: SparkSession, config: dict) -> DataFrame:
    """Config: ``{"path": ..., "base_dir": None, "schema": None, "multi_line": None}``."""
    if not config.get("path"):
        raise ExtractError("a file source needs a 'path'")
    path = resolve_path(config["path"], config.get("base_dir"))
    return read_csv(spark, path, config.get("schema"), config.get("multi_line"))


def _header(spark: SparkSession, path: str, options: dict) -> list[str]:
    try:
        names = spark.read.options(header=True, escape='"', **options).csv(path).columns
    except AnalysisException as exc:
        raise ExtractError(f"cannot open {path}: {first_line(exc)}") from exc
    if not names:
        raise ExtractError(f"nothing in {path}")
    return names


def _surplus(names: list[str]) -> Column:
    """The raw row, if it has more fields than the header.

    The reader hands over the raw text of any row whose number of fields is not the header's; quoted
    cells aside, the commas tell which way.
    """
    bare = F.regexp_replace(F.col(SURPLUS), '"(?:[^"]|"")*"', "")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.when(fields > len(names), F.col(SURPLUS))


def _lines(spark: SparkSession, path: str, names: list[str], options: dict) -> DataFrame:
    """Cells of every line taken by itself, and whether the line leaves a quote open or reads like the header."""
    schema = ", ".join(f"{quoted(n)} string" for n in [*names, SURPLUS])
    text = spark.read.options(**options).text(path)
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    parsed = text.select(
        F.from_csv("value", schema, {"escape": '"', "columnNameOfCorruptRecord": SURPLUS}).alias("r"),
        (quotes % 2 == 1).alias("open"),
    )
    is_header = reduce(
        lambda a, b: a & b, [F.col(f"r.{quoted(n)}").eqNullSafe(F.lit(n)) for n in names]
    )
    cells = parsed.select(
        *[F.when(~is_header, F.col(f"r.{quoted(n)}")).alias(n) for n in [*names, SURPLUS]],
        F.when(F.col("open"), F.lit("open")).alias(OPEN_QUOTE), F.when(is_header, F.lit("header")).alias(HEADER),
    )
    return cells.withColumn(SURPLUS, _surplus(names))


# So many files at most are read by their own when some of them cannot be split.
MOST_FILES = 1000


def _unsplittable(spark: SparkSession, path: str, options: dict) -> tuple[list[str], list[str]]:
    """The files with a line that leaves a quote open, and the others; empty lists where there are too many
    files to name."""
    text = spark.read.options(**options).text(path)
    everything = [unquote(f) for f in text.inputFiles()]
    if len(everything) > MOST_FILES:
        return [], []
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    found = text.filter(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("f")).distinct()
    place = lambda f: re.sub("^([a-z0-9]+:)?/+", "/", f)
    whole = {place(unquote(r.f)) for r in found.collect()}
    return [f for f in everything if place(f) in whole], [f for f in everything if place(f) not in whole]


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, multi_line: bool | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Typed rows plus the hidden position struct.

    One pass over the whole input finds the types, checks the field counts and looks for cells that
    hold line breaks; files with such cells cannot be split and are read once more as a whole, the others
    in splits all the same. With ``schema`` (a DDL string) and ``multi_line`` given, there is no such pass.
    Short rows are padded with NULL, long rows are an error.
    """
    options = options or {}
    names = _header(spark, path, options)
    surveyed, apart = None, None
    if multi_line is None:
        surveyed = _survey(_lines(spark, path, names, options))
        multi_line = OPEN_QUOTE in surveyed
        if multi_line:
            apart = _unsplittable(spark, path, options)
        if HEADER in surveyed and surveyed[HEADER].n > len(spark.read.options(**options).text(path).inputFiles()):
            surveyed = None  # a data row reads like the header, so only the reader tells them apart
    text_schema = ", ".join(f"{quoted(n)} string" for n in [*names, SURPLUS])

    def cells_of(paths, whole: bool) -> DataFrame:
        return spark.read.schema(text_schema).options(
            header=True, escape='"', multiLine=whole, columnNameOfCorruptRecord=SURPLUS, **options
        ).csv(paths).withColumns({
            PLACE: F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        })

    if apart and all(apart):
        raw = cells_of(apart[0], True).unionByName(cells_of(apart[1], False))
    else:
        raw = cells_of(path, multi_line)
    raw = raw.withColumn(SURPLUS, _surplus(names))
    cells = {n: F.when(~F.col(quoted(n)).isin(*NULL_TOKENS), F.col(quoted(n))) for n in names}
    if schema is None:
        types = _infer(_survey(raw.drop(PLACE)) if multi_line or surveyed is None else surveyed, names, path)
    else:
        from pyspark.sql.types import StructType

        types = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(schema)}
        lacking = [n for n in types if n not in names]
        if lacking:
            raise ExtractError(f"{path} has no column {lacking}")
        names = [n for n in names if n in types]
    position = F.struct(
        F.col(f"{PLACE}.file").alias("file"), F.col(f"{PLACE}.block").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = raw.select(
        *[cells[n].alias(n) for n in names], F.col(SURPLUS), position.alias(POSITION)
    )
    if schema is not None:
        tooth = F.raise_error(F.lit(f"{path} has a row with more fields than the header"))
        placed = placed.filter(F.when(F.col(SURPLUS).isNotNull(), tooth.cast("boolean")).otherwise(True))
    return placed.select(*[_typed(n, types[n]).alias(n) for n in names], POSITION)


def _typed(name: str, dtype: str) -> Column:
    col = F.col(quoted(name))
    if dtype == "string":
        return col
    return F.trim(col).cast(dtype)


# What a cell reads as, from the narrowest kind on.
WHOLE, NUMBER, TRUTH, TEXT = 1, 2, 3, 4


def _kind(cell: Column) -> Column:
    # The patterns come first: a cast that fails raises and catches an exception per cell.
    whole = cell.rlike(INTEGER_PATTERN)
    decimal = cell.rlike(DECIMAL_PATTERN) | cell.rlike(INFINITY_PATTERN)
    return (
        F.when(whole & cell.try_cast("bigint").isNotNull(), WHOLE)
        .when(decimal & ~whole, NUMBER)
        .when(cell.isin(*BOOLEAN_TOKENS), TRUTH)
        .otherwise(TEXT)
    )


def _survey(cells: DataFrame) -> dict:
    """Kinds found per column, over all rows; columns without any value are not in it.

    Cells are looked at one per row, so the generated code stays small however wide the file is;
    the counts per column are combined before the shuffle.
    """
    names = cells.columns
    every = F.array(*[F.col(quoted(n)) for n in names])
    tall = cells.select(F.posexplode(every).alias("at", "cell"))
    present = tall.filter(~F.col("cell").isin(*NULL_TOKENS)).select("at", F.trim("cell").alias("cell"))
    kinds = present.select("at", _kind(F.col("cell")).alias("kind"))
    found = kinds.groupBy("at").agg(
        F.min("kind").alias("least"), F.max("kind").alias("most"), F.count("kind").alias("n")
    )
    return {names[r.at]: r for r in found.collect()}


def _infer(seen: dict, names: list[str], path: str) -> dict[str, str]:
    """Narrowest of bigint, double, boolean, string per column."""
    if SURPLUS in seen:
        raise ExtractError(f"{path} has {seen[SURPLUS].n} row(s) with more fields than the header")
    types = {}
    for name in names:
        kinds = seen.get(name)
        if kinds is None or kinds.most == NUMBER:
            types[name] = "double"
        elif kinds.most == WHOLE:
            types[name] = "bigint"
        else:
            types[name] = "boolean" if kinds.least == kinds.most == TRUTH else "string"
    return types
