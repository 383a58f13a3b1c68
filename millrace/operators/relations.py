"""Filters and columns along declared relationships.

A :class:`Model` names tables and how a column of one refers to the key of another. ``path__column=value``
then filters by what a row refers to, over any number of steps: each table on the way is filtered first, cut
down to the one column that the next step needs, and met by a semi-join, so no row ever appears twice and
nothing is read that the filter does not name. Conditions that share a path hold for the same referred row.

    model.filtered("anomalies", dataset__name="crm", column="age", run__status__in=["FAILED"])

A relation followed backwards (``reverse``) asks whether any referring row fits. A name that is neither a
column nor a relation is an error that says so. NULL refers to nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.types import quoted
from millrace.operators.joins import broadcast_if_small

STEP = "__"
# Last parts of a condition that say how to compare; without one, values are equal.
COMPARISONS: dict[str, Callable[[Column, object], Column]] = {
    "in": lambda col, values: col.isin(list(values)),
    "isnull": lambda col, wanted: col.isNull() if wanted else col.isNotNull(),
    "gt": lambda col, value: col > F.lit(value),
    "gte": lambda col, value: col >= F.lit(value),
    "lt": lambda col, value: col < F.lit(value),
    "lte": lambda col, value: col <= F.lit(value),
}


class UnknownPath(ValueError):
    """A condition names what the model does not have."""


@dataclass(frozen=True)
class Relation:
    """``column`` of a table holds values of ``key`` of table ``to``."""

    column: str
    to: str
    key: str
    backwards: bool = False


@dataclass
class Model:
    """Tables by name, lazily given, and the relations between them."""

    tables: dict[str, Callable[[], DataFrame] | DataFrame] = field(default_factory=dict)
    relations: dict[str, dict[str, Relation]] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise UnknownPath(f"no table {name!r}; known: {sorted(self.tables)}")
        given = self.tables[name]
        return given() if callable(given) else given

    def refers(self, table: str, name: str, column: str, to: str, key: str, reverse: str | None = None) -> "Model":
        """Declare that ``column`` of ``table`` refers to ``key`` of ``to``, under ``name``, and under ``reverse``
        the other way round."""
        self.relations.setdefault(table, {})[name] = Relation(column, to, key)
        if reverse:
            self.relations.setdefault(to, {})[reverse] = Relation(key, table, column, backwards=True)
        return self

    # -- paths ----------------------------------------------------------------------------------

    def _split(self, table: str, path: str) -> tuple[list[str], str, str | None]:
        """The relations, the column and the comparison that a condition's name has."""
        steps, rest, at = [], path, table
        while True:
            columns = self.table(at).columns
            if rest in columns:
                return steps, rest, None
            head, _, tail = rest.rpartition(STEP)
            if head in columns and tail in COMPARISONS:
                return steps, head, tail
            step, found, after = rest.partition(STEP)
            relation = self.relations.get(at, {}).get(step)
            if relation is None or not found:
                known = sorted([*columns, *self.relations.get(at, {})])
                raise UnknownPath(f"{path!r}: table {at!r} has no {step if found else rest!r}; it has {known}")
            steps.append(step)
            at, rest = relation.to, after

    def filtered(self, table: str, **conditions) -> DataFrame:
        """The rows of a table that fit all conditions, with the table's columns.

        A value of None asks for NULL.
        """
        own: list[tuple[str, str | None, object]] = []
        along: dict[str, dict[str, object]] = {}
        for path, value in conditions.items():
            steps, column, comparison = self._split(table, path)
            if steps:
                along.setdefault(steps[0], {})[path.split(STEP, 1)[1]] = value
            else:
                own.append((column, comparison, value))
        rows = self.table(table)
        for column, comparison, value in own:
            rows = rows.filter(_condition(F.col(quoted(column)), comparison, value))
        for step, deeper in along.items():
            relation = self.relations[table][step]
            referred = self.filtered(relation.to, **deeper).select(F.col(quoted(relation.key)).alias("__key"))
            keys = referred.filter(F.col("__key").isNotNull())
            # Referring rows come many to a key, and may all come to one.
            keys = broadcast_if_small(keys.distinct() if relation.backwards else keys)
            rows = rows.join(keys, F.col(quoted(relation.column)) == F.col("__key"), "left_semi")
        return rows

    def with_related(self, rows: DataFrame, table: str, **columns: str) -> DataFrame:
        """The rows of a table with columns of what they refer to: ``dataset_name="dataset__name"``.

        Only along relations that lead to one row at most; rows that refer to nothing get NULL. Each referred table
        is met once per path, with no more than the columns asked for. One row stands for a key that repeats.
        """
        paths: dict[str, dict[str, str]] = {}
        for name, path in columns.items():
            steps, column, comparison = self._split(table, path)
            if not steps or comparison:
                raise UnknownPath(f"{path!r} does not lead from {table!r} to a column of another table")
            paths.setdefault(steps[0], {})[name] = path.split(STEP, 1)[1]
        for step, wanted in paths.items():
            relation = self.relations[table][step]
            if relation.backwards:
                raise UnknownPath(f"{step!r} leads from a row of {table!r} to many rows of {relation.to!r}")
            near = {n: p for n, p in wanted.items() if p in self.table(relation.to).columns}
            far = {n: p for n, p in wanted.items() if n not in near}
            referred = self.table(relation.to)
            if far:
                referred = self.with_related(referred, relation.to, **far)
            values = [F.col(quoted(p)).alias(n) for n, p in near.items()] + [F.col(quoted(n)) for n in far]
            found = referred.select(F.col(quoted(relation.key)).alias("__key"), F.struct(*values).alias("__found"))
            one = found.filter(F.col("__key").isNotNull()).groupBy("__key").agg(F.min("__found").alias("__found"))
            rows = rows.join(broadcast_if_small(one), F.col(quoted(relation.column)) == F.col("__key"), "left").withColumns(
                {n: F.col("__found")[n] for n in wanted}
            ).drop("__key", "__found")
        return rows


def _condition(column: Column, comparison: str | None, value: object) -> Column:
    if comparison:
        return COMPARISONS[comparison](column, value)
    return column.isNull() if value is None else column == F.lit(value)
