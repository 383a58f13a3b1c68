"""As-of join: each row with the latest earlier record of another table.

Both tables go into one, ordered by key and time, where a row takes the last record before it. So a record is
never paired with every row that it may belong to: the work grows with the rows of both tables, whatever the
number of rows per key. A key that is too large for a task is cut into range pieces by key and time, and the
last record of a piece travels to the next ones in a summary row (:mod:`millrace.operators.sequence`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.operators.sequence import HOT_KEY_ROWS, along_key, pieces_needed


def asof_join(
    left: DataFrame, right: DataFrame, by: list[str], on: str, right_on: str, *, exact: bool = False,
    most_seconds: float | None = None, hot_key_rows: int | None = HOT_KEY_ROWS,
) -> DataFrame:
    """The rows of ``left``, each with the columns of the latest row of ``right`` of the same ``by``.

    Latest is the greatest ``right_on`` before ``on`` (or equal to it, with ``exact``) and at most ``most_seconds``
    before it; of several at that time the one with the greatest other columns. Without such a row the columns are
    NULL, as they are where ``on`` or a key is NULL. Rows of ``left`` that repeat all stay. ``right`` must
    have no column of ``left`` besides ``by``, and its other columns an order (no maps).
    """
    values = [c for c in right.columns if c not in by]
    clashing = [c for c in values if c in left.columns]
    if clashing:
        raise ValueError(f"both tables have {clashing}")
    keys = [f"__by_{i}" for i in range(len(by))]
    known = F.lit(True)
    for c in [*by, right_on]:
        known = known & F.col(quoted(c)).isNotNull()
    found = F.struct(F.col(quoted(right_on)).alias("__when"), *[F.col(quoted(c)).alias(c) for c in values])
    # Of equal times those of the right come first if they count, else last.
    records = right.filter(known).select(
        *[F.col(quoted(c)).alias(k) for c, k in zip(by, keys)], F.col(quoted(right_on)).alias("__time"),
        F.lit(0 if exact else 2).alias("__side"), found.alias("__record"),
    )
    rows = left.select(
        *[F.col(quoted(c)).alias(k) for c, k in zip(by, keys)], F.col(quoted(on)).alias("__time"), F.lit(1).alias("__side"),
        F.struct(*[F.col(quoted(c)) for c in left.columns]).alias("__row"),
    )
    both = rows.unionByName(records, allowMissingColumns=True)
    joined = along_key(
        both, keys, ["__time", "__side", "__record"], pieces=pieces_needed(both, keys, hot_key_rows),
        latest={"__latest": F.col("__record")},
    ).filter(F.col("__side") == 1)
    match = F.col("__latest")
    if most_seconds is not None:
        age = F.unix_micros(F.col("__time").cast("timestamp")) - F.unix_micros(match["__when"].cast("timestamp"))
        match = F.when(age <= F.lit(round(most_seconds * 1_000_000)), match)
    return joined.withColumn("__latest", match).select(
        "__row.*", *[F.col("__latest")[c].alias(c) for c in values]
    )
