"""SQL query results through Spark's JDBC source."""

from __future__ import annotations

import re
from datetime import date, datetime
from decimal import Decimal
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession

from millrace.errors import ExtractError

_PLACEHOLDER = re.compile(r"%%|%s|%\((\w+)\)s")
_DSN_PAIR = re.compile(r"(\w+)\s*=\s*('(?:[^'\\]|\\.)*'|\S+)")


def sql_literal(value) -> str:
    """A bind value as a typed SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    raise ExtractError(f"cannot bind a {type(value).__name__}")


def bind(query: str, params) -> str:
    """Replace ``%s`` / ``%(name)s`` placeholders; ``%%`` is a plain percent sign."""
    if not params:
        return query
    positional = iter(params) if not isinstance(params, dict) else None

    def one(match: re.Match) -> str:
        if match.group() == "%%":
            return "%"
        try:
            value = params[match.group(1)] if match.group(1) else next(positional)
        except (KeyError, StopIteration, TypeError) as exc:
            raise ExtractError(f"no value for {match.group()!r} in the query") from exc
        return sql_literal(value)

    return _PLACEHOLDER.sub(one, query)


def connection_options(dsn: str) -> dict[str, str]:
    """JDBC url and credentials from a JDBC url, a ``postgresql://`` URI or ``key=value`` pairs."""
    if dsn.startswith("jdbc:"):
        return {"url": dsn}
    if "://" in dsn:
        parts = urlsplit(dsn)
        host, port, database = parts.hostname or "localhost", parts.port or 5432, parts.path.lstrip("/")
        user, password = parts.username, parts.password
        extra = dict(parse_qsl(parts.query))
    else:
        pairs = {k: v.strip("'") for k, v in _DSN_PAIR.findall(dsn)}
        host, port = pairs.pop("host", "localhost"), pairs.pop("port", 5432)
        database, user, password = pairs.pop("dbname", ""), pairs.pop("user", None), pairs.pop("password", None)
        extra = pairs
    if not database:
        raise ExtractError("the dsn names no database")
    options = {"url": f"jdbc:postgresql://{host}:{port}/{database}", "driver": "org.postgresql.Driver"}
    if user:
        options["user"] = unquote(user)
    if password:
        options["password"] = unquote(password)
    return {**options, **extra}


def reader_options(config: dict) -> dict[str, str]:
    """All options of the JDBC read.

    With ``partition_column``, ``lower_bound``, ``upper_bound`` and ``num_partitions`` the query is
    read by that many tasks; without them by a single one, so big tables should set them. Further
    filters on the resulting frame are pushed into the database.
    """
    if not config.get("dsn") or not config.get("query"):
        raise ExtractError("a SQL source needs 'dsn' and 'query'")
    query = bind(config["query"], config.get("params")).rstrip().rstrip(";")
    options = connection_options(config["dsn"])
    options["dbtable"] = f"({query}) AS source"
    options["fetchsize"] = str(config.get("fetch_size", 10_000))
    if config.get("partition_column"):
        for name in ("lower_bound", "upper_bound", "num_partitions"):
            if config.get(name) is None:
                raise ExtractError(f"'partition_column' also needs {name!r}")
        options.update(
            partitionColumn=config["partition_column"], lowerBound=str(config["lower_bound"]),
            upperBound=str(config["upper_bound"]), numPartitions=str(config["num_partitions"]),
        )
    if config.get("driver"):
        options["driver"] = config["driver"]
    return options


def read_jdbc(spark: SparkSession, config: dict) -> DataFrame:
    return spark.read.format("jdbc").options(**reader_options(config)).load()
