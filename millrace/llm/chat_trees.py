r"""Chat formatting of reply trees.

Messages (tree, node, parent, role, text, score) form trees. Self-joins that double their reach, as many as
the logarithm of the depth, give each node its depth and branch score (:func:`_measured`), and each leaf its path from
the root (:func:`root_paths`): a node whose depth is a multiple of a power of two has the block of so many nodes
up from it, made of two blocks of half the length, so that all blocks of one length together hold
every node once. Per tree the path with the best mean score is chosen, then the longest, then the one
with the smallest leaf. Each chosen path becomes one conversation.

The template writes a turn as ``### role: text</turn>`` and a line feed. Within roles and texts a backslash is
doubled, ``###`` becomes ``#\\##`` and ``</turn>`` ``<\\/turn>``, in a role ``:`` becomes ``\\:``: no mark can occur inside
a turn, and undoing it gives the text back (:func:`read_back`). The loss mask covers the texts of
assistant turns without marks.

Defined results: NULL role or text is empty; a conversation's turns follow each other by turn, then
role and text, so that turns with the same number, and rows that repeat, all have a place (a NULL turn comes
first); conversations are told apart by conv_id, of which NULL is one; an empty table has no
conversation. A message whose parent is not there is a root; messages that are their own ancestors
belong to no path. Nodes have to be unique within a tree. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.staging import broadcast_if_few, staged
from millrace.operators.joins import BROADCAST_BYTES

# Bytes of a node's row in a broadcast.
NODE_BYTES = 96
MARK, END, SEPARATOR = "### ", "</turn>", ": "
LEARNED_ROLE = "assistant"
REPORT = (
    "tree bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint,"
    " formatted string, loss_spans array<struct<start:int,end:int>>"
)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.DOTALL)


def escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</turn>", "<\\/turn>")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans of it that count for the loss."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{MARK}{escaped(role).replace(':', chr(92) + ':')}{SEPARATOR}", escaped(text)
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), spans


def read_back(conversation: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(conversation):
        turn = _TURN.match(conversation, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(turn[1]), unescaped(turn[2])))
        at = turn.end()
    return turns


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(conversation: str, spans: list[tuple[int, int]]) -> tuple:
    """What can be told from the output alone: turns, text under the loss mask, length."""
    turns = read_back(conversation)
    learned = "".join(unescaped(conversation[a:b]) for a, b in spans)
    told = "".join(f"{role}\n{text}\n" for role, text in turns)
    return len(turns), _digest(told), len(learned), _digest(learned), len(conversation)


def _conversations(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in ("tree", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "formatted", "loss_spans")]
    for batch in batches:
        rows = []
        for tree, turns in zip(batch["tree"], batch["turns"], strict=True):
            text, spans = formatted([(t["role"], t["text"]) for t in turns])
            rows.append((None if pd.isna(tree) else int(tree), *digests(text, spans), text, [{"start": a, "end": b} for a, b in spans]))
        out = pd.DataFrame(rows, columns=names)
        yield out.assign(tree=out["tree"].astype("Int64"))


def _measured(nodes: DataFrame) -> DataFrame:
    """tree, node, parent, and of the path to the root: depth (0 at the root) and the scores' sum.

    Every round joins each node with the one its pointer has reached, which doubles the reach. Nodes
    that never reach a root are left out.
    """
    known = broadcast_if_few(nodes.select(F.col("tree").alias("kt"), F.col("node").alias("kn")), NODE_BYTES)
    linked = nodes.join(known, F.col("tree").eqNullSafe(F.col("kt")) & (F.col("parent") == F.col("kn")), "left")
    reach = linked.select("tree", "node", F.col("kn").alias("parent"), F.col("kn").alias("at"), F.when(F.col("kn").isNotNull(), 1).otherwise(0).alias("depth"), F.col("score").alias("total"))
    reach = staged(reach, "reach")
    total, turn = reach.count(), 0
    done, going = reach.where("at is null"), reach.where("at is not null")
    # a path has fewer nodes than the table: what still goes on after so many rounds is a circle
    while not going.isEmpty() and total >> turn:
        every = done.unionByName(going)
        further = every.select(F.col("tree").alias("ft"), F.col("node").alias("fn"), F.col("at").alias("fa"), F.col("depth").alias("fd"), F.col("total").alias("fs"))
        further = F.broadcast(further) if total * NODE_BYTES <= BROADCAST_BYTES else further
        joined = going.join(further, F.col("tree").eqNullSafe(F.col("ft")) & (F.col("at") == F.col("fn")))
        reach = staged(
            joined.select(
                "tree", "node", "parent", F.col("fa").alias("at"), (F.col("depth") + F.col("fd")).alias("depth"),
                (F.col("total") + F.col("fs")).alias("total"),
            ),
            "reach",
        )
        done, going = done.unionByName(reach.where("at is null")), reach.where("at is not null")
        turn += 1
    return done.drop("at")


def best_leaves(measured: DataFrame) -> DataFrame:
    """Per tree the leaf of the best branch: by mean score, then length, then smallest node."""
    parents = measured.select(F.col("tree").alias("pt"), F.col("parent").alias("pp")).where("pp is not null").distinct()
    leaves = measured.join(parents, F.col("tree").eqNullSafe(F.col("pt")) & (F.col("node") == F.col("pp")), "left_anti")
    rank = F.struct((-F.col("total") / (F.col("depth") + 1)).alias("score"), (-F.col("depth")).alias("length"), "node")
    return leaves.groupBy("tree").agg(F.min(rank).alias("best")).select("tree", F.col("best.node").alias("leaf"))


def root_paths(measured: DataFrame, leaves: DataFrame) -> DataFrame:
    """tree, leaf and ``path``, the nodes from the root to each of the leaves (tree, leaf)."""
    wanted = leaves.select("tree", F.col("leaf").alias("node"))
    start = wanted.join(measured.select(F.col("tree").alias("mt"), F.col("node").alias("mn"), "depth"), F.col("tree").eqNullSafe(F.col("mt")) & (F.col("node") == F.col("mn")))
    walk = start.select("tree", F.col("node").alias("leaf"), F.col("node").alias("at"), (F.col("depth") + 1).alias("left"), F.expr("cast(array() as array<bigint>)").alias("path"))
    blocks = measured.select("tree", "node", F.col("parent").alias("above"), "depth", F.array("node").alias("block"))
    size, deepest = 1, measured.agg(F.max("depth")).first()[0] or 0
    while size <= deepest + 1:
        row_bytes = NODE_BYTES + 8 * size
        step = broadcast_if_few(blocks.select(F.col("tree").alias("bt"), F.col("node").alias("bn"), "above", "block"), row_bytes)
        due = F.col("left").bitwiseAND(F.lit(size)) > 0
        joined = walk.join(step, F.col("tree").eqNullSafe(F.col("bt")) & (F.col("at") == F.col("bn")) & due, "left")
        walk = staged(
            joined.select(
                "tree", "leaf", F.when(due, F.col("above")).otherwise(F.col("at")).alias("at"), "left",
                F.when(due, F.concat("block", "path")).otherwise(F.col("path")).alias("path"),
            ),
            "walk",
        )
        upper = blocks.select(F.col("tree").alias("ut"), F.col("node").alias("un"), F.col("above").alias("ua"), F.col("block").alias("ub"))
        upper = broadcast_if_few(upper, row_bytes)
        aligned = blocks.where((F.col("depth") + 1) % (2 * size) == 0)
        blocks = staged(
            aligned.join(upper, F.col("tree").eqNullSafe(F.col("ut")) & (F.col("above") == F.col("un")))
            .select("tree", "node", F.col("ua").alias("above"), "depth", F.concat("ub", "block").alias("block")),
            "blocks",
        )
        size *= 2
    return walk.select("tree", "leaf", "path")


def chats(messages: DataFrame) -> DataFrame:
    """One formatted conversation per tree of (tree, node, parent, role, text, score), with its digests."""
    nodes = staged(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")), "nodes")
    measured = staged(_measured(nodes), "measured")
    paths = root_paths(measured, best_leaves(measured))
    places = paths.select(F.col("tree").alias("pt"), F.posexplode("path").alias("place", "pn"))
    turns = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = turns.join(places, F.col("tree").eqNullSafe(F.col("pt")) & (F.col("node") == F.col("pn")))
    listed = chosen.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    return listed.mapInPandas(_conversations, REPORT)


def linear(conversations: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees without branches."""
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    placed = conversations.withColumn("node", F.row_number().over(order).cast("bigint"))
    return placed.select(
        F.col("conv_id").cast("bigint").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
        "role", "text", F.lit(0.0).alias("score"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    told = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id bigint, turn bigint, role string, text string")
    found = chats(staged(linear(told.unionByName(own)), "messages"))
    return found.drop("formatted", "loss_spans").withColumnRenamed("tree", "conv_id")


SQL = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
turns AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ':', '\:') AS head
  FROM all_rows)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""
