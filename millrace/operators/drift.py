"""Schema history: what columns a dataset had in which run, and how they changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.operators.transform import last_per_key
from millrace.operators.sequence import HOT_KEY_ROWS, along_key, pieces_needed


def columns_of(df: DataFrame, hidden: tuple[str, ...] = ()) -> list[dict]:
    return [{"name": n, "dtype": t} for n, t in df.dtypes if n not in hidden]


def schema_profile(df: DataFrame) -> DataFrame:
    """(position, name, dtype, populated) per column; one aggregation counts the filled cells."""
    filled = df.agg(*[F.count(F.col(quoted(n))).alias(f"c{i}") for i, n in enumerate(df.columns)])
    columns = [
        F.struct(
            F.lit(i).alias("position"), F.lit(n).alias("name"), F.lit(t).alias("dtype"),
            F.col(f"c{i}").alias("populated"),
        )
        for i, (n, t) in enumerate(df.dtypes)
    ]
    return filled.select(F.inline(F.array(*columns)))


def diff_schema(before: list[dict], after: list[dict], rename_map: dict | None = None) -> dict | None:
    """Added, removed, renamed and retyped columns, or None if no name changed.

    A removed and an added name that the rename map pairs up count as one rename.
    """
    old = {c["name"]: c["dtype"] for c in before}
    new = {c["name"]: c["dtype"] for c in after}
    if old.keys() == new.keys():
        return None
    renamed = [
        {"from": a, "to": b}
        for a, b in (rename_map or {}).items()
        if a in old and a not in new and b in new and b not in old
    ]
    gone = {r["from"] for r in renamed}
    come = {r["to"] for r in renamed}
    return {
        "added": sorted(new.keys() - old.keys() - come),
        "removed": sorted(old.keys() - new.keys() - gone),
        "renamed": renamed,
        "type_changes": sorted(n for n in old.keys() & new.keys() if old[n] != new[n]),
    }


def _without(names: Column, drop: Column) -> Column:
    return F.array_sort(F.array_except(names, drop))


def schema_drift(
    observed: DataFrame, keys: list[str], run_order: str, name: str,
    rename_map: dict[str, str] | None = None, *, hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """Versions of every dataset from its whole history of observed column names.

    ``observed`` has one row per dataset, run and column. Result: one row per run whose set of
    names differs from the run before, with sorted ``added``/``removed`` names and ``renamed``
    pairs ("old>new"); the first run is version 1 and no drift.
    """
    per_run = observed.groupBy(*keys, run_order).agg(
        F.array_sort(F.collect_set(F.col(quoted(name)))).alias("names")
    )
    pieces = pieces_needed(per_run, keys, hot_key_rows)
    seen = along_key(
        per_run, keys, [run_order], pieces=pieces,
        previous={"__was": F.struct(F.col("names").alias("n"))},
    ).withColumn("__was", F.col("__was")["n"])
    changed = seen.filter(F.col("__was").isNull() | (F.col("__was") != F.col("names")))
    changed = along_key(
        changed.withColumn("__one", F.lit(1)), keys, [run_order], pieces=pieces,
        sums_before={"__earlier": F.col("__one")},
    )
    first = F.col("__was").isNull()
    was = F.coalesce(F.col("__was"), F.col("names"))
    lost, gained = F.array_except(was, F.col("names")), F.array_except(F.col("names"), was)
    pairs = [
        F.when(
            F.array_contains(lost, F.lit(a)) & F.array_contains(gained, F.lit(b)),
            F.struct(F.lit(a).alias("from"), F.lit(b).alias("to")),
        )
        for a, b in (rename_map or {}).items()
    ]
    renamed = (
        F.array_compact(F.array(*pairs)) if pairs
        else F.array().cast("array<struct<from:string,to:string>>")
    )
    return changed.withColumn("renamed", renamed).select(
        *keys, run_order,
        (F.coalesce(F.col("__earlier"), F.lit(0)) + 1).cast("int").alias("version"),
        "names",
        _without(gained, F.col("renamed")["to"]).alias("added"),
        _without(lost, F.col("renamed")["from"]).alias("removed"),
        "renamed",
        (~first).alias("is_drift"),
    )


def latest_version(versions: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version row of every dataset."""
    return last_per_key(versions, keys, ["version"])


def column_catalog(observed: DataFrame, keys: list[str], run_order: str) -> DataFrame:
    """Latest dtype and first/last sighting of every column; columns are never forgotten."""
    return observed.groupBy(*keys, "name").agg(
        F.max_by("dtype", run_order).alias("dtype"),
        F.min(run_order).alias("first_seen"),
        F.max(run_order).alias("last_seen"),
    )
