"""Read side: equality filters, scoping, masking and paging over served tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import mask_email
from millrace.functions.types import quoted
from millrace.operators.joins import broadcast_if_small

PAGE_SIZE = 25
# Roles that read addresses unmasked.
PRIVILEGED_ROLES = ("ADMIN", "ENGINEER")


def matching(df: DataFrame, **equals) -> DataFrame:
    """Rows whose columns equal the given values; the filters reach the scan."""
    return reduce(lambda d, kv: d.filter(F.col(quoted(kv[0])) == F.lit(kv[1])), equals.items(), df)


def page(df: DataFrame, order_by: list, number: int = 1, size: int = PAGE_SIZE) -> DataFrame:
    """Page ``number`` (from 1) in a total order."""
    return df.orderBy(*order_by).offset(size * (number - 1)).limit(size)


def page_after(df: DataFrame, order_by: list[str], last: tuple | None, size: int = PAGE_SIZE) -> DataFrame:
    """The page that follows the row with the given ordering values.

    However deep the page, only ``size`` rows are kept per task, unlike with an offset.
    """
    if last is not None:
        here = F.struct(*[F.col(quoted(c)) for c in order_by])
        mark = F.struct(*[F.lit(v).cast(df.schema[c].dataType).alias(c) for c, v in zip(order_by, last)])
        lead = F.col(quoted(order_by[0]))
        # The first comparison is implied by the second and can be pushed into the scan.
        df = df.filter(lead >= F.lit(last[0])).filter(here > mark)
    return df.orderBy(*[F.col(quoted(c)) for c in order_by]).limit(size)


def visible_to(df: DataFrame, memberships: DataFrame, member, scope: str, scope_in_memberships: str = "scope") -> DataFrame:
    """Rows of the scopes the reader belongs to.

    A semi-join never multiplies rows, so the scopes need no ``distinct``; without it both sides
    come straight from a shuffle, which is what lets Spark split a scope that holds too many rows.
    """
    own = memberships.filter(F.col("member") == F.lit(member)).select(
        F.col(quoted(scope_in_memberships)).alias(scope)
    )
    return df.join(broadcast_if_small(own), scope, "left_semi")


def masked(df: DataFrame, column: str = "email", role: str | None = None) -> DataFrame:
    privileged = role in PRIVILEGED_ROLES
    return df.withColumn(column, mask_email(F.col(quoted(column)), privileged))
