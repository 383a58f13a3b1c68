"""Rows that break blocking rules, set aside and later replayed.

A batch is written once, in two partitions: the rows to go on, and the quarantined ones with the rules they
break and a digest that names the row. Corrections refer to rows by that digest.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.operators.duplicates import row_digest
from millrace.operators.rules import RuleSet, judged_by_row

FLAG, BROKEN, DIGEST, ORIGIN = "_quarantined", "_broken_rules", "_row_digest", "_origin_run"
ADDED = (FLAG, BROKEN, DIGEST, ORIGIN)


def with_broken_rules(
    df: DataFrame, rules: list[dict], run_id: str, as_of: datetime | None = None, hidden: tuple[str, ...] = ()
) -> DataFrame:
    """The batch with the labels of the blocking rules that each row breaks, whether there are any, the
    row's digest and the run. Rules that compare rows do not count here."""
    compiled = RuleSet.compile(df, rules, as_of, hidden)
    broken = [
        F.when(F.coalesce(c.row_violation, F.lit(False)), F.lit(c.label)) for c in judged_by_row(compiled).values()
    ]
    labels = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    seen = [f for f in df.schema if f.name not in hidden]
    marked = compiled.flagged().withColumns({BROKEN: labels.cast("array<string>"), DIGEST: F.lower(F.hex(row_digest(seen)))})
    return marked.select(
        *[F.col(quoted(c)) for c in df.columns], BROKEN, DIGEST, F.lit(run_id).alias(ORIGIN), (F.size(BROKEN) > 0).alias(FLAG)
    )


def excused(df: DataFrame, rules: list[dict], as_of: datetime | None, hidden: tuple[str, ...]) -> frozenset[int]:
    """Positions of the rules whose broken rows a quarantine takes."""
    return frozenset(judged_by_row(RuleSet.compile(df, rules, as_of, hidden)))


def corrected(quarantined: DataFrame, corrections: DataFrame) -> DataFrame:
    """The quarantined rows that have a correction, with its values in place of theirs.

    Corrections have the digest and any of the rows' columns; a column that they lack stays as it is. Values
    take the column's type.
    """
    given = [c for c in corrections.columns if c != DIGEST]
    unknown = [c for c in given if c not in quarantined.columns]
    if unknown:
        raise ValueError(f"corrections have columns that the rows do not: {unknown}")
    values = corrections.select(DIGEST, F.struct(F.lit(1).alias("known"), *[F.col(quoted(c)) for c in given]).alias("_fixed"))
    joined = quarantined.join(values, DIGEST)
    types = dict((f.name, f.dataType) for f in quarantined.schema)
    return joined.withColumns(
        {c: F.col("_fixed")[c].cast(types[c]) for c in given}
    ).select(*[F.col(quoted(c)) for c in quarantined.columns])
