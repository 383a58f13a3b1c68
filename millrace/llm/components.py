"""Connected components of a large set of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import broadcast_if_few, staged


# Bytes of a (node, label) row in a broadcast.
LABEL_BYTES = 64


def relabelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """The rows with ``column`` replaced by its label; what has none keeps its value.

    Labels are broadcast if they are few; else a join that Spark may split on a skewed column, as no
    aggregation stands above it.
    """
    known = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    joined = rows.join(known, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_label", column)).drop("_node", "_label")


def contracted(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label) for each node of the links (a, b); a label is one node of the component.

    ``labels`` are those that earlier links gave. Every round points each node at its smallest
    neighbour, follows that pointer a few times, and merges it there. Nodes have to be spread like random numbers (hashes
    are), so that a round about halves what is left, whatever the links' shape. The smallest neighbour
    comes from a partial aggregation, so a node with very many links is no burden. Rounds are staged: a
    lost executor costs no more than a round.
    """
    spark = links.sparkSession
    ends = links.select("a", "b")
    if labels is not None:
        ends = relabelled(relabelled(ends, labels, "a"), labels, "b")
    edges = staged(ends.where("a <> b").distinct(), "links")
    rounds = []
    while count := edges.count():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("label"))
        near = broadcast_if_few(staged(near, "near", 2 * count), LABEL_BYTES)
        twice = relabelled(near, near, "label")
        steps = broadcast_if_few(staged(relabelled(twice, twice, "label"), "steps", 2 * count), LABEL_BYTES)
        rounds.append(steps)
        edges = staged(relabelled(relabelled(edges, steps, "a"), steps, "b").where("a <> b").distinct(), "links", count)
    if not rounds:
        return spark.createDataFrame([], "node bigint, label bigint") if labels is None else labels
    found = rounds[0]
    if labels is not None:
        found = relabelled(labels, rounds[0], "label").unionByName(found.join(labels.select("node"), "node", "left_anti"))
    for steps in rounds[1:]:
        found = relabelled(found, steps, "label")
    return broadcast_if_few(staged(found, "labels"), LABEL_BYTES)
