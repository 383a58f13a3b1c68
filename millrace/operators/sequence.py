"""Ordered work per key that survives a key holding a third of the table.

A window over ``(key, order)`` puts all rows of a key into one task. Where the largest key is too
big for that, rows are range-partitioned by key AND order instead, which cuts a hot key into many
pieces; whatever crosses the border of a piece travels in one summary row per piece and key.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.session import ensure_checkpoint_dir

# Rows of one key that a single task sorts without trouble.
HOT_KEY_ROWS = 5_000_000


def _columns(names: list[str]) -> list[Column]:
    return [F.col(quoted(n)) for n in names]


def pieces_needed(df: DataFrame, keys: list[str], hot_key_rows: int | None = HOT_KEY_ROWS) -> int:
    """0 if every key fits one task, else the number of pieces to cut the table into.

    Reads the key columns only and pre-aggregates before the shuffle. Callers whose keys are
    bounded by construction (one row per day, say) pass None and save that job.
    """
    if hot_key_rows is None:
        return 0
    counted = df.groupBy(*_columns(keys)).count()
    size = counted.agg(F.max("count").alias("largest"), F.sum("count").alias("total")).first()
    if not size.largest or size.largest <= hot_key_rows:
        return 0
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, ceil(size.total / hot_key_rows))


def along_key(
    df: DataFrame, keys: list[str], order_by: list[str], *, pieces: int,
    previous: dict[str, Column] | None = None, following: dict[str, Column] | None = None,
    first: dict[str, Column] | None = None, sums_before: dict[str, Column] | None = None,
    latest: dict[str, Column] | None = None,
) -> DataFrame:
    """Add columns that look along the ordered rows of a key.

    ``previous``/``following`` take a struct from the neighbouring row (NULL where there is none),
    ``first`` a struct from the key's first row, ``sums_before`` a sum over all earlier rows (NULL
    on the first), ``latest`` a struct from the last earlier row where it is not NULL. ``order_by`` must
    be unique within a key. ``pieces`` comes from :func:`pieces_needed`.
    """
    previous, following = previous or {}, following or {}
    first, sums_before, latest = first or {}, sums_before or {}, latest or {}
    if not pieces:
        return df.withColumns(_windows(keys, order_by, previous, following, first, sums_before, latest))

    # The range bounds come from sampling, so the assignment is written to reliable storage once:
    # summaries and rows must see the same pieces, also after an executor is lost.
    ensure_checkpoint_dir(df.sparkSession)
    rows = (
        df.repartitionByRange(pieces, *_columns(keys), *_columns(order_by))
        .withColumn("__piece", F.spark_partition_id())
        .checkpoint()
    )
    position = F.struct(*_columns(order_by))
    summary = rows.groupBy("__piece", *_columns(keys)).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.max_by(c, position).alias(f"last:{n}") for n, c in previous.items()],
        *[F.min_by(c, position).alias(f"head:{n}") for n, c in (following | first).items()],
        *[F.sum(c).alias(f"part:{n}") for n, c in sums_before.items()],
        *[F.max_by(c, F.when(c.isNotNull(), position)).alias(f"late:{n}") for n, c in latest.items()],
    )
    across = Window.partitionBy(*_columns(keys)).orderBy("__piece")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = {
        **{n: F.lag(quoted(f"last:{n}")).over(across) for n in previous},
        **{n: F.lead(quoted(f"head:{n}")).over(across) for n in following},
        **{n: F.first(quoted(f"head:{n}")).over(across) for n in first},
        **{n: F.sum(quoted(f"part:{n}")).over(earlier) for n in sums_before},
        **{n: F.last(quoted(f"late:{n}"), ignorenulls=True).over(earlier) for n in latest},
    }
    # Only keys that span pieces need anything carried: at most two rows per piece are left.
    borders = (
        summary.withColumn("__pieces", F.count(F.lit(1)).over(Window.partitionBy(*_columns(keys))))
        .select(
            F.col("__piece").alias("__at"), "__pieces",
            *[F.col(quoted(k)).alias(f"__key_{i}") for i, k in enumerate(keys)],
            *[c.alias(f"carried:{n}") for n, c in carried.items()],
        )
        .filter(F.col("__pieces") > 1)
    )
    match = F.col("__piece") == F.col("__at")
    for i, k in enumerate(keys):
        match = match & F.col(quoted(k)).eqNullSafe(F.col(f"__key_{i}"))
    within = _windows(["__piece", *keys], order_by, previous, following, first, sums_before, latest)
    joined = rows.withColumns(within).join(borders, match, "left")
    merged = {}
    for n in [*previous, *following, *latest]:
        merged[n] = F.coalesce(F.col(quoted(n)), F.col(quoted(f"carried:{n}")))
    for n in first:
        merged[n] = F.coalesce(F.col(quoted(f"carried:{n}")), F.col(quoted(n)))
    for n in sums_before:
        inside, before = F.col(quoted(n)), F.col(quoted(f"carried:{n}"))
        merged[n] = F.coalesce(inside + before, inside, before)
    return joined.withColumns(merged).select(*_columns(df.columns), *_columns(list(merged)))


def _windows(keys, order_by, previous, following, first, sums_before, latest) -> dict[str, Column]:
    window = Window.partitionBy(*_columns(keys)).orderBy(*_columns(order_by))
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return {
        **{n: F.lag(c).over(window) for n, c in previous.items()},
        **{n: F.lead(c).over(window) for n, c in following.items()},
        **{n: F.first(c).over(window) for n, c in first.items()},
        **{n: F.sum(c).over(earlier) for n, c in sums_before.items()},
        **{n: F.last(c, ignorenulls=True).over(earlier) for n, c in latest.items()},
    }
