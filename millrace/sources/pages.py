"""Paged JSON responses, landed as one file per page.

Fetching pages over HTTP is not Spark's work; the files may come from any downloader. Their names
end in the page number. Records count up to the first empty page, and every page before it has to be
there. Where ``max_pages`` is given, more pages than that are an error, not a shorter result.

The files are read once, and each page is parsed once, into a VARIANT that is written down; page numbers, the
records' columns and the rows all come from there. Pages may differ: a column that only some records have is
NULL in the others, one that has several types is text, a value that does not fit a given type is NULL.
``page_drift`` tells from page to page which columns came, went or changed their type.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.errors import ExtractError
from millrace.functions.types import quoted
from millrace.lake import files
from millrace.sources.registry import POSITION

PAGE_NUMBER = r"(\d+)[^0-9/]*$"


def read_landed_pages(spark: SparkSession, config: dict) -> DataFrame:
    """Config::

        {"path": "<folder or glob>", "results_path": "data" | None, "schema": None,
         "page_pattern": None, "pagination": {"start_page": 1, "max_pages": None}}

    ``schema`` is the DDL of one record; without it Spark infers it from the pages.
    ``page_pattern`` finds the page number in the path where the file name does not end in it.
    """
    path = config.get("path")
    if not path:
        raise ExtractError("a paged JSON source needs the 'path' of its landed pages")
    paging = config.get("pagination", {})
    start = paging.get("start_page", 1)
    return union_pages(
        spark, path, config.get("results_path"), start, paging.get("max_pages"),
        config.get("schema"), config.get("page_pattern") or PAGE_NUMBER,
    )


def _page_files(spark: SparkSession, path: str, results_path: str | None, page_pattern: str) -> DataFrame:
    """(page, size, records) of every landed file, parsed once and staged; NULL records where there is no list."""
    # One page is one HTTP response, so a whole file per row stays small.
    document = F.try_parse_json("value")
    listing = F.try_variant_get(document, f"$['{results_path}']", "variant") if results_path else document
    landed = spark.read.text(path, wholetext=True).select(
        F.regexp_extract("_metadata.file_path", page_pattern, 1).cast("bigint").alias("page"), listing.alias("listing")
    )
    parsed = landed.select("page", F.try_variant_get("listing", "$", "array<variant>").alias("records"))
    return files.staged(parsed.withColumn("size", F.size("records")), "pages")


def _checked(pages: DataFrame, start_page: int, max_pages: int | None) -> DataFrame:
    """The pages of records, from the first to the one before the first empty one."""
    spark = pages.sparkSession
    pages = pages.filter(F.col("page") >= start_page)
    bad = F.col("records").isNull()
    seen = pages.agg(
        F.min(F.when(F.col("size") == 0, F.col("page"))).alias("first_empty"),
        F.min(F.when(bad, F.col("page"))).alias("first_bad"),
        F.max("page").alias("last"),
    ).first()
    end = seen.first_empty if seen.first_empty is not None else (seen.last or start_page - 1) + 1
    if seen.first_bad is not None and seen.first_bad < end:
        raise ExtractError(f"page {seen.first_bad} holds no list of records")
    if max_pages is not None and end - start_page > max_pages:
        raise ExtractError(f"there are {end - start_page} pages of records, {max_pages} at most were expected")
    pages = pages.filter(F.col("page") < end)
    numbers = pages.select("page").distinct()
    if numbers.count() != end - start_page:
        wanted = spark.range(start_page, end).select(F.col("id").alias("page"))
        lacking = wanted.join(numbers, "page", "left_anti").agg(F.min("page").alias("page")).first().page
        raise ExtractError(f"page {lacking} is missing")
    return pages


def landed_pages(spark: SparkSession, config: dict) -> DataFrame:
    """(page, records) of a paged source, checked; for ``page_columns`` and ``page_drift``."""
    paging = config.get("pagination", {})
    pattern = config.get("page_pattern") or PAGE_NUMBER
    pages = _page_files(spark, config["path"], config.get("results_path"), pattern)
    return _checked(pages, paging.get("start_page", 1), paging.get("max_pages")).select("page", "records")


def _fields(pages: DataFrame) -> DataFrame:
    """(page, name, value) of every field of every record."""
    records = pages.select("page", F.explode("records").alias("record"))
    return records.lateralJoin(
        pages.sparkSession.tvf.variant_explode(F.col("record").outer())
    ).select("page", F.col("key").alias("name"), "value").filter(F.col("name").isNotNull())


# Where a type begins in the text of a schema: at its head, behind a field's name, inside ARRAY<...>.
_TYPE = re.compile(r"(?:^|(?<=: )|(?<=ARRAY<))(OBJECT<>|OBJECT<|VOID|VARIANT|DECIMAL\(\d+,\d+\))")


def _spark_type(text: str) -> str:
    """A VARIANT's schema as a Spark type: fractions as doubles; what has no one type as text."""

    def replaced(match: re.Match) -> str:
        found = match[1]
        if found == "OBJECT<":
            return "STRUCT<"
        if found.startswith("DECIMAL"):
            return found if found.endswith(",0)") else "DOUBLE"
        return "STRING"

    return _TYPE.sub(replaced, text)


def _ddl(dtype: T.DataType) -> str:
    """A type as SQL reads it, with every field's name quoted."""
    if isinstance(dtype, T.StructType):
        return "STRUCT<" + ", ".join(f"{quoted(f.name)}: {_ddl(f.dataType)}" for f in dtype) + ">"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{_ddl(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"MAP<{_ddl(dtype.keyType)}, {_ddl(dtype.valueType)}>"
    return dtype.simpleString()


def page_columns(pages: DataFrame) -> DataFrame:
    """(page, name, dtype, records): the columns of each page and how many of its records have them."""
    return _fields(pages).groupBy("page", "name").agg(
        F.schema_of_variant_agg("value").alias("dtype"), F.count(F.lit(1)).alias("records")
    )


def page_drift(columns: DataFrame) -> DataFrame:
    """(page, name, change, before, after) for each page but the first: what differs from the page before.

    ``columns`` as from :func:`page_columns`; ``change`` is added, removed or type. A page's columns meet the
    columns of the page before as rows of the same name, so nothing is compared on one machine.
    """
    ends = columns.agg(F.min("page").alias("first"), F.max("page").alias("last")).first()
    here = columns.select("page", "name", F.col("dtype").alias("after"))
    there = columns.select((F.col("page") + 1).alias("page"), "name", F.col("dtype").alias("before"))
    met = here.join(there, ["page", "name"], "full").filter(
        (F.col("page") > F.lit(ends.first)) & (F.col("page") <= F.lit(ends.last))
    )
    change = (
        F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed")
        .when(F.col("before") != F.col("after"), "type")
    )
    return met.select("page", "name", change.alias("change"), "before", "after").filter(F.col("change").isNotNull())


def _record_type(pages: DataFrame, schema: str | None) -> T.StructType:
    """The given type of a record, or all fields of all records by name."""
    if schema:
        return T.StructType.fromDDL(schema)
    found = _fields(pages).groupBy("name").agg(F.schema_of_variant_agg("value").alias("dtype"))
    ddl = [f"{quoted(r.name)} {_spark_type(r.dtype)}" for r in sorted(found.collect(), key=lambda r: r.name)]
    return T.StructType.fromDDL(", ".join(ddl)) if ddl else T.StructType()


def union_pages(
    spark: SparkSession, path: str, results_path: str | None = None, start_page: int = 1,
    max_pages: int | None = None, schema: str | None = None, page_pattern: str = PAGE_NUMBER,
) -> DataFrame:
    found = _page_files(spark, path, results_path, page_pattern)
    if results_path and schema is None and found.filter("records IS NOT NULL").isEmpty():
        raise ExtractError(f"no page has a {results_path!r} key")
    pages = _checked(found, start_page, max_pages)
    record = _record_type(pages, schema)
    if not record.fields:
        raise ExtractError("the pages hold no records")
    rows = pages.select("page", F.posexplode("records").alias("at", "record"))
    position = F.struct(
        F.lit("").alias("file"), F.col("page").alias("block"), F.col("at").cast("bigint").alias("row")
    )
    typed = F.try_variant_get("record", "$", _ddl(record))
    return rows.select(typed.alias("record"), position.alias(POSITION)).select(
        *[F.col(f"record.{quoted(n)}").alias(n) for n in record.names], POSITION
    )
