"""Mixing sources to target weights: a token budget handed down a domain-language-source tree.

Each level's weights (1 where none is given) share a node's budget among its children. A child gets at
most what it can supply, its tokens times ``max_epochs``; what it cannot take goes to its siblings in
proportion to their weights, and only what none of them can take reaches the node above, whose own
siblings take it over (:func:`_filled` is one level of that: every node's supply is known before its
budget, so a node is never given more than its children hold). A leaf then takes whole epochs and, of
the next one, the longest prefix in the epoch's seeded order that stays within its budget.

The order is that of ``md5(seed:epoch:doc_id)``. Where a leaf's prefix ends is found from token sums of
``BUCKETS`` ranges of that order, and exactly within the one range in which it ends; so no task sorts
a leaf, however large. The result per leaf is one hash, up to which rows are taken.

Only DataFrame functions are used. Defined results: a NULL or empty text has no tokens and comes with
its place in the order; a NULL key is a value like any other; rows that share a doc_id have the same
place and are taken together or not at all; a leaf without tokens gives nothing; an empty table gives
an empty one. Further columns pass through :func:`mixed_rows`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.staging import staged
from millrace.operators.joins import broadcast_if_small

LEVELS = ("domain", "language", "source")
SEED = 13
# Hex digits of the hash that name a range.
BUCKET_DIGITS = 3
BUCKETS = 16**BUCKET_DIGITS

# The weights asked for.
WEIGHTS = {"language": {"en": 5, "de": 2, "fr": 2, "es": 1}, "domain": {"src": 2, "src1": 1}}
SHARE = 0.6
MAX_EPOCHS = 2

WORDS = r"[^\x20\x09-\x0D]+"


def token_count(text: str = "text") -> Column:
    """Words separated by ASCII white space."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORDS)), F.lit(0)).cast("bigint")


def document_keys(source: str = "source", language: str = "lang") -> dict[str, Column]:
    """The tree's keys of a document; the domain is the source's name without a final digit."""
    return {
        "domain": F.coalesce(F.regexp_replace(F.col(source), "[0-9]$", ""), F.lit("")),
        "language": F.coalesce(F.col(language), F.lit("")),
        "source": F.coalesce(F.col(source), F.lit("")),
    }


def _weight(level: str, weights: Mapping[str, Mapping[str, int]]) -> Column:
    out = F.lit(1)
    for name, weight in weights.get(level, {}).items():
        out = F.when(F.col(level) == name, F.lit(weight)).otherwise(out)
    return out.cast("bigint")


def _filled(nodes: DataFrame, parent: Sequence[str], level: str) -> DataFrame:
    """One level: each node's ``budget`` from its parent's ``given``, its weight and its supply.

    In order of supply by weight, a node is short while all nodes from it on, at its ratio, would take
    no more than is left; the rest share what is left by weight.
    """
    siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    ranked = siblings.orderBy("ratio", level)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    onward = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    marked = (
        nodes.withColumn("supply", F.when(F.col("weight") > 0, F.col("supply")).otherwise(0))
        .withColumn("ratio", F.when(F.col("weight") > 0, F.col("supply") / F.col("weight")).otherwise(F.lit(0.0)))
        .withColumn("taken", F.coalesce(F.sum("supply").over(before), F.lit(0)))
        .withColumn("onward", F.sum("weight").over(onward))
        .withColumn("short", F.col("ratio") * F.col("onward") + F.col("taken") <= F.col("given"))
    )
    left = F.col("given") - F.sum(F.when(F.col("short"), F.col("supply")).otherwise(0)).over(siblings)
    sharing = F.sum(F.when(F.col("short"), 0).otherwise(F.col("weight"))).over(siblings)
    return marked.withColumn(
        "budget", F.when(F.col("short"), F.col("supply").cast("double")).otherwise(left * F.col("weight") / sharing)
    )


def leaf_budgets(
    leaves: DataFrame, share: float, max_epochs: int, weights: Mapping[str, Mapping[str, int]], levels: Sequence[str] = LEVELS
) -> DataFrame:
    """The leaves (levels and ``tokens``) with ``budget``: whole tokens, in all ``share`` of one epoch."""
    supply = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    total = supply.agg(F.sum("tokens").alias("tokens"), F.sum("supply").alias("supply"))
    given = total.select(F.least(F.floor(F.col("tokens") * F.lit(share)), F.col("supply")).cast("double").alias("given"))
    above: DataFrame | None = None
    for depth, level in enumerate(levels):
        parent, keys = list(levels[:depth]), list(levels[: depth + 1])
        nodes = supply.groupBy(*keys).agg(F.sum("supply").alias("supply")).withColumn("weight", _weight(level, weights))
        if above is None:
            nodes = nodes.withColumn("given", given.scalar())
        else:
            nodes = nodes.join(above.withColumnRenamed("budget", "given"), parent)
        above = _filled(nodes, parent, level).select(*keys, "budget")
    return leaves.join(above, list(levels)).withColumn("budget", F.floor(F.col("budget") + 1e-6).cast("bigint"))


def place(doc_id: str, epoch: Column, seed: int) -> Column:
    """A row's place in the order of an epoch."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit(""))))


def leaf_plan(
    docs: DataFrame, keys: Mapping[str, Column], share: float = SHARE, max_epochs: int = MAX_EPOCHS,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS, seed: int = SEED,
) -> DataFrame:
    """Per leaf: tokens, budget, ``epochs`` taken whole, and ``until``, the last place of the next one."""
    levels = list(keys)
    rows = staged(docs.select("doc_id", *[c.alias(k) for k, c in keys.items()], token_count().alias("tokens")), "tokens")
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    budgets = leaf_budgets(leaves, share, max_epochs, weights, levels).where("tokens > 0")
    plan = staged(
        budgets.withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens")),
        "leaves",
    )
    small = broadcast_if_small(plan.select(*levels, "epochs", "rest"))
    placed = rows.join(small, levels).select(
        *levels, "rest", "tokens", place("doc_id", F.col("epochs"), seed).alias("place")
    ).withColumn("range", F.substring("place", 1, BUCKET_DIGITS))
    sums = placed.groupBy(*levels, "range").agg(F.sum("tokens").alias("own"), F.first("rest").alias("rest"))
    ahead = Window.partitionBy(*levels).orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = sums.withColumn("reached", F.sum("own").over(ahead)).where("reached > rest").groupBy(*levels).agg(
        F.min("range").alias("range"), F.min_by(F.col("reached") - F.col("own"), "range").alias("before")
    )
    ends = staged(ends, "ends")
    last = placed.join(broadcast_if_small(ends), [*levels, "range"])
    within = Window.partitionBy(*levels).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inside = last.withColumn("reached", F.col("before") + F.sum("tokens").over(within)).where("reached <= rest")
    until = inside.groupBy(*levels).agg(F.max("place").alias("inside"))
    return (
        plan.join(ends.select(*levels, "range"), levels, "left").join(until, levels, "left")
        .withColumn("until", F.coalesce("inside", "range")).select(*levels, "tokens", "budget", "epochs", "until")
    )


def mixed_rows(
    docs: DataFrame, keys: Mapping[str, Column], share: float = SHARE, max_epochs: int = MAX_EPOCHS,
    weights: Mapping[str, Mapping[str, int]] = WEIGHTS, seed: int = SEED,
) -> tuple[DataFrame, str]:
    """The chosen rows, one for each epoch they are taken in, with a struct of keys and epoch, and its name.

    The plan is joined by broadcast after its bytes were counted; beyond that by a join whose skewed
    leaves Spark splits.
    """
    from millrace.llm.staging import fresh_name

    plan = staged(leaf_plan(docs, keys, share, max_epochs, weights, seed), "plan")
    mix, leaf = fresh_name(docs, "mix"), fresh_name(docs, "leaf")
    plan = broadcast_if_small(plan.select(F.struct(*keys).alias(leaf), F.struct("epochs", "until").alias(mix)))
    joined = docs.withColumn(leaf, F.struct(*[c.alias(k) for k, c in keys.items()])).join(plan, leaf)
    epochs, until = F.col(f"`{mix}`.epochs"), F.col(f"`{mix}`.until")
    also = F.coalesce(place("doc_id", epochs, seed) <= until, F.lit(False))
    last = F.when(also, epochs).otherwise(epochs - 1)
    taken = joined.where(last >= 0).withColumn(mix, F.explode(F.sequence(F.lit(0), last)))
    return taken.withColumn(mix, F.struct(F.col(f"`{leaf}`.*"), F.col(f"`{mix}`").alias("epoch"))).drop(leaf), mix


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows, mix = mixed_rows(docs, document_keys())
    return rows.select("doc_id", f"`{mix}`.*")


SQL = f"""
WITH docs AS (
  SELECT doc_id, coalesce(regexp_replace(source, '[0-9]$', ''), '') AS domain, coalesce(lang, '') AS language,
         coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
  FROM documents),
leaves AS (
  SELECT domain, language, source, sum(tokens)::BIGINT AS tokens, {MAX_EPOCHS} * sum(tokens)::BIGINT AS supply,
         CASE domain WHEN 'src' THEN 2 ELSE 1 END AS w1,
         CASE language WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w2
  FROM docs GROUP BY ALL),
n1 AS (SELECT domain, any_value(w1) AS w, sum(supply) AS supply, sum(supply)::DOUBLE / any_value(w1) AS ratio,
         (SELECT least(floor(sum(tokens) * {SHARE}), sum(supply)) FROM leaves)::DOUBLE AS given
       FROM leaves GROUP BY domain),
s1 AS (SELECT *, ratio * sum(w) OVER (ORDER BY ratio, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         + coalesce(sum(supply) OVER (ORDER BY ratio, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= given AS short
       FROM n1),
b1 AS (SELECT domain, CASE WHEN short THEN supply ELSE (given - sum(CASE WHEN short THEN supply ELSE 0 END) OVER ()) * w
         / sum(CASE WHEN short THEN 0 ELSE w END) OVER () END AS budget FROM s1),
n2 AS (SELECT domain, language, any_value(w2) AS w, sum(supply) AS supply, sum(supply)::DOUBLE / any_value(w2) AS ratio, any_value(budget)::DOUBLE AS given
       FROM leaves JOIN b1 USING (domain) GROUP BY domain, language),
s2 AS (SELECT *, ratio * sum(w) OVER (PARTITION BY domain ORDER BY ratio, language ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         + coalesce(sum(supply) OVER (PARTITION BY domain ORDER BY ratio, language ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= given AS short
       FROM n2),
b2 AS (SELECT domain, language, CASE WHEN short THEN supply ELSE (given - sum(CASE WHEN short THEN supply ELSE 0 END) OVER (PARTITION BY domain)) * w
         / sum(CASE WHEN short THEN 0 ELSE w END) OVER (PARTITION BY domain) END AS budget FROM s2),
n3 AS (SELECT domain, language, source, tokens, 1 AS w, supply, supply::DOUBLE AS ratio, budget::DOUBLE AS given
       FROM leaves JOIN b2 USING (domain, language)),
s3 AS (SELECT *, ratio * sum(w) OVER (PARTITION BY domain, language ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         + coalesce(sum(supply) OVER (PARTITION BY domain, language ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) <= given AS short
       FROM n3),
b3 AS (SELECT domain, language, source, tokens, floor(CASE WHEN short THEN supply
         ELSE (given - sum(CASE WHEN short THEN supply ELSE 0 END) OVER (PARTITION BY domain, language)) * w
         / sum(CASE WHEN short THEN 0 ELSE w END) OVER (PARTITION BY domain, language) END + 1e-6)::BIGINT AS budget FROM s3),
plan AS (SELECT domain, language, source, budget // tokens AS epochs, budget % tokens AS rest FROM b3 WHERE tokens > 0),
placed AS (
  SELECT doc_id, domain, language, source, epochs, rest,
         sum(tokens) OVER (PARTITION BY domain, language, source ORDER BY md5(concat('{SEED}:', epochs, ':', coalesce(doc_id::VARCHAR, '')))) AS reached
  FROM docs JOIN plan USING (domain, language, source))
SELECT doc_id, domain, language, source, epoch::INTEGER AS epoch
FROM (SELECT *, unnest(range(0, epochs + CASE WHEN reached <= rest THEN 1 ELSE 0 END)) AS epoch FROM placed)
"""
