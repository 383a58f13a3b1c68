"""Loads into a keyed dimension: Type-1 upsert and Type-2 history.

A load is described by a :class:`DimensionSpec` and is a pure function of the current rows and the
batch. Writing the result is the business of ``millrace.lake.targets``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.errors import LoadError
from millrace.functions.types import quoted
from millrace.operators.joins import BROADCAST_BYTES, key_bytes
from millrace.operators.sequence import HOT_KEY_ROWS, along_key, pieces_needed
from millrace.operators.transform import last_per_key

VALIDITY = {"valid_from": "timestamp", "valid_to": "timestamp", "is_current": "boolean"}


@dataclass(frozen=True)
class DimensionSpec:
    """Shape of a dimension.

    ``tracked`` attributes open a new version when they change; ``carried`` ones keep the value of
    the oldest version. ``defaults`` fill attributes the batch has no column for.
    """

    key: str = "external_id"
    source_key: str = "customer_id"
    tracked: tuple[str, ...] = ("first_name", "last_name", "email", "country")
    carried: tuple[str, ...] = ("signup_date",)
    required: tuple[str, ...] = ("email",)
    types: dict = field(default_factory=lambda: {"signup_date": "date"})
    defaults: dict = field(
        default_factory=lambda: {"first_name": "", "last_name": "", "country": ""}
    )
    column_order: tuple[str, ...] = (
        "external_id", "first_name", "last_name", "email", "signup_date", "country",
        "valid_from", "valid_to", "is_current",
    )

    @property
    def attributes(self) -> list[str]:
        return [*self.tracked, *self.carried]

    def type_of(self, name: str) -> str:
        return VALIDITY.get(name) or self.types.get(name, "string")

    @property
    def columns(self) -> list[str]:
        return list(self.column_order) or [self.key, *self.attributes, *VALIDITY]

    @property
    def schema(self) -> str:
        return ", ".join(f"{quoted(c)} {self.type_of(c)}" for c in self.columns)


CUSTOMERS = DimensionSpec()


def _instant(now: datetime | Column) -> Column:
    return now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")


# The batch's ordering columns travel in one struct: they may have the names of attributes.
ORDER = "__order"


def incoming(batch: DataFrame, spec: DimensionSpec, order_by: tuple[str, ...] = ()) -> DataFrame:
    """The batch in dimension shape: text key, known attributes only, defaults for absent ones.

    With ``order_by``, a struct of these columns of the batch as well.
    """
    lacking = [c for c in (spec.source_key, *spec.required) if c not in batch.columns]
    if lacking:
        raise LoadError(f"the batch has no column {', '.join(map(repr, lacking))}")

    def attribute(name: str) -> Column:
        dtype = spec.type_of(name)
        if name not in batch.columns:
            return F.lit(spec.defaults.get(name)).cast(dtype)
        col = F.col(quoted(name))
        if name in spec.carried:
            col = F.nullif(col.cast("string"), F.lit(""))
        return col.cast(dtype)

    # Rows without a key share the empty one (blank cells are missing, so no real key is blank).
    key = F.coalesce(F.col(quoted(spec.source_key)).cast("string"), F.lit(""))
    return batch.select(
        key.alias(spec.key),
        *[attribute(a).alias(a) for a in spec.attributes],
        *([F.struct(*[F.col(quoted(c)) for c in order_by]).alias(ORDER)] if order_by else []),
    )


def keys_fit_broadcast(batch: DataFrame, spec: DimensionSpec, limit: int = BROADCAST_BYTES) -> bool:
    """Whether the distinct keys of a batch are small enough to broadcast.

    Where they are, the dimension meets them without a shuffle. Spark only knows that by itself
    if the whole batch is tiny.
    """
    return key_bytes(incoming(batch, spec).select(spec.key).distinct()) <= limit


def _keys(keyed: DataFrame, spec: DimensionSpec, broadcast: bool) -> DataFrame:
    keys = keyed.select(spec.key)
    return F.broadcast(keys) if broadcast else keys


def _known(current: DataFrame, keyed: DataFrame, spec: DimensionSpec, broadcast: bool = False) -> DataFrame:
    """Current rows of the given keys. Unlike an outer join, this leaves the dimension in place
    when the keys are broadcast."""
    return current.join(_keys(keyed, spec, broadcast), spec.key, "left_semi")


def upsert_type1(
    current: DataFrame, batch: DataFrame, spec: DimensionSpec, order_by: list[str],
    now: datetime | Column, *, broadcast_keys: bool = False, created: Observation | None = None,
) -> DataFrame:
    """Current rows after overwriting known keys and adding new ones; the last row of a key wins.

    An overwritten row keeps its ``valid_from``. Both sides meet with at most one row per key.
    ``created`` observes the number of new keys while the result is written.
    """
    latest = last_per_key(incoming(batch, spec, tuple(order_by)), [spec.key], [ORDER])
    # The key set is a plain distinct, the same for both joins, so the ranking runs only once.
    keys = incoming(batch, spec).select(spec.key).distinct()
    known = _known(current, keys, spec, broadcast_keys).select(spec.key, F.col("valid_from").alias("__since"))
    matched = latest.join(known, spec.key, "left")
    if created is not None:
        matched = matched.observe(created, F.count(F.when(F.col("__since").isNull(), 1)).alias("keys"))
    loaded = matched.select(
        spec.key, *spec.attributes,
        F.coalesce(F.col("__since"), _instant(now)).alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    untouched = current.join(_keys(keys, spec, broadcast_keys), spec.key, "left_anti")
    return untouched.select(*spec.columns).unionByName(loaded.select(*spec.columns))


def upsert_counts(
    current: DataFrame, batch: DataFrame, spec: DimensionSpec, *, broadcast_keys: bool = False
) -> DataFrame:
    """(created, updated): first sight of a key creates it, every further row updates it."""
    per_key = incoming(batch, spec).groupBy(spec.key).agg(F.count(F.lit(1)).alias("n"))
    keys = incoming(batch, spec).select(spec.key).distinct()
    known = _known(current, keys, spec, broadcast_keys).select(spec.key, F.lit(True).alias("__known"))
    joined = per_key.join(known, spec.key, "left")
    created = F.count(F.when(F.col("__known").isNull(), 1))
    return joined.agg(
        created.alias("created"), (F.coalesce(F.sum("n"), F.lit(0)) - created).cast("bigint").alias("updated")
    )


def version_chain(
    rows: DataFrame, keys: list[str], tracked: list[str], carried: list[str], order_by: list[str],
    *, valid_from: str = "valid_from", pieces: int = 0,
) -> DataFrame:
    """Turn ordered observations into versions; ``pieces`` as found by ``pieces_needed``.

    A row that repeats the tracked values of the row before it vanishes. Every other row becomes a
    version valid until the next one; ``opens_key`` marks the first of its key. Values compare
    null-safe.
    """
    watched = F.struct(*[F.col(quoted(c)) for c in tracked])
    origin = {"__origin": F.struct(*[F.col(quoted(c)) for c in carried])} if carried else {}
    seen = along_key(rows, keys, order_by, pieces=pieces, previous={"__before": watched}, first=origin)
    kept = seen.filter(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(watched))
    kept = kept.withColumns(
        {
            "opens_key": F.col("__before").isNull(),
            **{c: F.col("__origin")[c] for c in carried},
        }
    ).drop("__before", *origin)
    since = F.struct(F.col(quoted(valid_from)).alias("t"))
    chained = along_key(kept, keys, order_by, pieces=pieces, following={"__next": since})
    return chained.withColumns(
        {"valid_to": F.col("__next")["t"], "is_current": F.col("__next").isNull()}
    ).drop("__next")


def merge_type2(
    current: DataFrame, batch: DataFrame, spec: DimensionSpec, order_by: list[str],
    now: datetime | Column, *, collapse: bool = False, hot_key_rows: int = HOT_KEY_ROWS,
    broadcast_keys: bool = False,
) -> DataFrame:
    """Versions of every key the batch names, with ``is_seed`` for those that already existed.

    Rows with ``is_current`` false are the versions this load closes. Several different rows of a
    key within one batch leave versions of zero length; ``collapse`` keeps only the last of them.
    Keys outside the batch do not appear.
    """
    arriving = incoming(batch, spec, tuple(order_by))
    if collapse:
        arriving = last_per_key(arriving, [spec.key], [ORDER])
    keys = arriving.select(spec.key).distinct()
    seeds = _known(current, keys, spec, broadcast_keys).select(
        spec.key, *spec.attributes, "valid_from", F.lit(0).alias("__step")
    )
    steps = arriving.withColumns({"valid_from": _instant(now), "__step": F.lit(1)})
    rows = seeds.unionByName(steps, allowMissingColumns=True)
    # A key has at most one seed, so the batch alone tells how many rows a task would get.
    chain = version_chain(
        rows, [spec.key], list(spec.tracked), list(spec.carried), ["__step", ORDER],
        pieces=pieces_needed(arriving, [spec.key], None if collapse else hot_key_rows),
    )
    return chain.select(*spec.columns, "opens_key", (F.col("__step") == 0).alias("is_seed"))


def merge_counts(versions: DataFrame) -> DataFrame:
    """(created, updated) of a Type-2 merge."""
    return versions.agg(
        F.count(F.when(F.col("opens_key") & ~F.col("is_seed"), 1)).alias("created"),
        F.count(F.when(~F.col("opens_key"), 1)).alias("updated"),
    )


def untouched_rows(
    current: DataFrame, batch: DataFrame, spec: DimensionSpec, *, broadcast_keys: bool = False
) -> DataFrame:
    keys = incoming(batch, spec).select(spec.key).distinct()
    return current.join(_keys(keys, spec, broadcast_keys), spec.key, "left_anti").select(*spec.columns)


def current_rows(dimension: DataFrame, spec: DimensionSpec = CUSTOMERS) -> DataFrame:
    return dimension.filter("is_current").select(*spec.columns)
