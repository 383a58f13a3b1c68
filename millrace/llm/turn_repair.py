"""Repair of conversations: the cheapest edits that make the roles alternate, by branch and bound.

A repaired conversation reads ``(system? (user assistant)+)?`` by the first letters of its roles. Edits, in
the order of the rows: Keep a row (0), Rerole it to user or assistant (2), Delete it (3; blank rows and rows
seen before have to go), Insert an empty turn of user or assistant (2). A truncated row that stays adds 1.
Of the cheapest repairs the one with the least audit (the edits' initials) is taken.

:func:`search` goes depth first over prefixes of edits with a stack of its own. A node is how many rows are
dealt with and what the last role was. What the rows left have to cost at least bounds a prefix from below; prefixes
that cannot beat the incumbent (cost, audit) go, and so do those that reach a node for more than the node's
table says was paid for it before. When the stack is empty the incumbent is proved best. Two prefixes of one
cost at one node are never the beginning of each other (they would differ by insertions, which cost), so what
is less at the node stays less at the end. Long conversations are searched :data:`BLOCK` rows at a time,
from each role that a block may begin with to each that it may end with, so that time grows with the rows.

A conversation meets in one row, as its result, one text digest and one audit, does. Rows come by turn (NULL
first; equal turns by role and text). NULL roles and texts count as one space; a role that begins with
none of s, u, a (also an empty one) can be reroled or deleted, not kept. Rows with a NULL conv_id are one
conversation. Repeated rows are duplicates, of which the first stays. Further columns do not matter.
"""

from __future__ import annotations

import os.path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 24
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
ROLES = {"u": "user", "a": "assistant"}

# What a repaired conversation's last role can be: none yet, system, user, assistant. It may end with these.
START, SYSTEM, USER, ASSISTANT = "", "s", "u", "a"
COMPLETE = (START, ASSISTANT)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}

# A row to the search: its role's initial, whether it must go, what it adds if it stays.
Row = tuple[str, bool, int]
Repair = tuple[int, str]


# Once a role has come, none of those before it in this order comes again.
_ORDER = {START: 0, SYSTEM: 1, USER: 2, ASSISTANT: 2}


class SuffixBounds:
    """What the rows from ``i`` on cost at least after a last role.

    Taken from an easier problem, in which only whose turn it is counts: there an opening without turns
    may end, and nothing tells the opening from what follows. No system row can be kept in it; as one can
    be at the start, what that may save is taken off there.
    """

    def __init__(self, rows: list[Row], accepted: tuple[str, ...]):
        self.latest = max(_ORDER[last] for last in accepted)
        ends = {_NEXT[last] for last in accepted}
        due = {who: 0 if who in ends else COSTS[INSERT] for who in (USER, ASSISTANT)}
        self.costs, self.savings, saving = [due], [0], 0
        for initial, gone, added in reversed(rows):
            before = {}
            for who, other in ((USER, ASSISTANT), (ASSISTANT, USER)):
                before[who] = due[who] + COSTS[DELETE]
                if not gone:
                    stays = COSTS[KEEP] if initial == who else COSTS[REROLE]
                    before[who] = min(before[who], due[other] + stays + added)
            due = {who: min(before[who], before[_NEXT[who]] + COSTS[INSERT]) for who in before}
            if initial == SYSTEM and not gone:
                saving = max(saving, COSTS[DELETE] - added)
            self.costs.append(due)
            self.savings.append(saving)
        self.costs.reverse()
        self.savings.reverse()

    def least(self, i: int, last: str) -> int | None:
        """The bound, or None where no accepted role can be reached any more."""
        if _ORDER[last] > self.latest:
            return None
        found = self.costs[i][_NEXT[last]]
        return found - self.savings[i] if last == START else found


def search(rows: list[Row], entry: str = START, accepted: tuple[str, ...] = COMPLETE) -> Repair | None:
    """The least (cost, audit) that leads from ``entry`` over all rows to an accepted last role."""
    n, bounds = len(rows), SuffixBounds(rows, accepted)
    best: Repair | None = None
    paid: dict[tuple[int, str], Repair] = {}
    stack: list[tuple[int, str, int, str]] = [(0, "", 0, entry)]
    while stack:
        cost, audit, i, last = stack.pop()
        left = bounds.least(i, last)
        if left is None:
            continue
        if best is not None:
            floor = cost + left
            if floor > best[0] or (floor == best[0] and audit > best[1][: len(audit)]):
                continue
        known = paid.get((i, last))
        if known is not None and known <= (cost, audit):
            continue
        paid[i, last] = (cost, audit)
        if i == n and last in accepted and (best is None or (cost, audit) < best):
            best = (cost, audit)
        due = _NEXT[last]
        edits = [(INSERT, i, due, 0)]
        if i < n:
            initial, gone, added = rows[i]
            edits.append((DELETE, i + 1, last, 0))
            if not gone:
                edits.append((REROLE, i + 1, due, added))
                if initial == due or (initial == SYSTEM and last == START):
                    edits.append((KEEP, i + 1, initial, added))
        # The most promising prefix comes off the stack first, of equal ones that with the least edit.
        ahead = []
        for edit, at, role, added in edits:
            spent = cost + COSTS[edit] + added
            ahead.append((spent + (bounds.least(at, role) or 0), edit, spent, at, role))
        for _, edit, spent, at, role in sorted(ahead, reverse=True):
            stack.append((spent, audit + edit, at, role))
    return best


def cheapest(rows: list[Row], block: int = BLOCK) -> Repair:
    """The least (cost, audit) for a whole conversation."""
    if len(rows) <= block:
        return search(rows)
    settled: list[str] = []
    open_ends: dict[str, Repair] = {START: (0, "")}
    for at in range(0, len(rows), block):
        part, reached = rows[at : at + block], {}
        for entry, (cost, audit) in open_ends.items():
            for leaving in _ORDER:
                found = search(part, entry, (leaving,))
                if found is not None:
                    whole = (cost + found[0], audit + found[1])
                    reached[leaving] = min(reached.get(leaving, whole), whole)
        # What all open prefixes begin with is settled, so that they stay short.
        common = os.path.commonprefix([audit for _, audit in reached.values()])
        settled.append(common)
        open_ends = {last: (cost, audit[len(common) :]) for last, (cost, audit) in reached.items()}
    cost, audit = min(open_ends[last] for last in COMPLETE if last in open_ends)
    return cost, "".join([*settled, audit])


def faults(turns: list[tuple[str, str]]) -> tuple[list[Row], dict[str, int]]:
    """The rows for the search and how many have which first fault; ``illegal`` counts neighbours."""
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    rows, seen = [], set()
    for role, text in turns:
        body = text.rstrip(SPACE)
        fault = (
            "blank" if not body else "duplicate" if (role, text) in seen
            else "truncated" if body[-1] not in ".!?" else None
        )
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        rows.append((role[:1], fault in ("blank", "duplicate"), TRUNCATED_COST if fault == "truncated" else 0))
    illegal = sum(a + b not in ("su", "ua", "au") for (a, _, _), (b, _, _) in zip(rows, rows[1:], strict=False))
    return rows, {**counts, "illegal": illegal}


def applied(turns: list[tuple[str, str]], audit: str) -> list[tuple[str, str]]:
    """The turns that a repair leaves; which role an edit gives follows from the one before."""
    out, last, left = [], START, iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == INSERT else next(left)
        if edit == DELETE:
            continue
        last = role[:1] if edit == KEEP else _NEXT[last]
        out.append((role if edit == KEEP else ROLES[last], text))
    return out


def repaired(turns: list[tuple[str, str]]) -> dict:
    """Faults, cost, audit and the repaired turns of one conversation."""
    rows, counts = faults(turns)
    cost, audit = cheapest(rows)
    return {**counts, "cost": cost, "audit": audit, "turns": [{"role": r, "text": t} for r, t in applied(turns, audit)]}


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "cost")
_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
RESULT = (
    "struct<" + ",".join(f"{c}:bigint" for c in _COUNTS) + ",audit:string,turns:array<struct<role:string,text:string>>>"
)


def _repairs(conversations: pa.Array) -> pa.Array:
    found = []
    for rows in conversations:
        turns = [(r["role"], r["text"]) for r in rows.as_py() for _ in range(r["copies"])]
        found.append(repaired(turns))
    kinds = [*[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("turns", _TURNS)]
    return pa.array(found, pa.struct(kinds))


def conversations_of(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """One row per conv_id: its turns in order and the gaps between their numbers.

    ``copies`` names a column that says how many times a row is there; a conversation whose rows are all
    there no time stays as an empty one.
    """
    there = F.col(f"`{copies}`").cast("int") if copies else F.lit(1)
    turn, present = F.col("turn").cast("bigint"), there > 0
    text = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    row = F.struct(turn.isNotNull().alias("known"), turn.alias("turn"), text("role"), text("text"), there.alias("copies"))
    numbers = F.when(present, turn)
    return rows.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.when(present, row))).alias("rows"),
        F.coalesce(
            F.max(numbers) - F.min(numbers) + 1 - F.size(F.collect_set(numbers)), F.lit(0)
        ).cast("bigint").alias("gaps"),
    )


def repair_conversations(rows: DataFrame, copies: str | None = None) -> DataFrame:
    """Per conv_id: gaps, the counts of faults, cost, audit, and the repaired ``turns``."""
    repairs = F.arrow_udf(_repairs, RESULT)
    found = conversations_of(rows, copies).withColumn("repair", repairs("rows"))
    return found.select("conv_id", "gaps", "repair.*")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations as rows: conv_id, turn (from 0), role, text."""
    return repair_conversations(rows).select("conv_id", F.posexplode("turns").alias("turn", "row")).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), "row.role", "row.text"
    )


def damaged(rows: DataFrame) -> DataFrame:
    """The rows with faults that follow from the checksum of conv_id and turn; ``copies`` is 0 for rows
    that are gone and 2 for those that come twice."""
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", known("conv_id"), known("turn")).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(known("role")).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(known("text"), "[.!?]", ""))
        .otherwise(known("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(spark.read.parquet(f"{folder}/conversations.parquet"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    return repair_conversations(rows, "copies").select(
        "conv_id", "gaps", *_COUNTS, "audit", F.sha2(lines.cast("binary"), 256).alias("repaired_sha256")
    )


# The checksum by its table, the least (cost, audit) at each node row after row, and the repaired rows by
# following the audit.
SQL = r"""
WITH RECURSIVE bits AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
spaced AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
kinds AS (SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda a, b: xor(a // 256, t[xor(a, b) % 256 + 1])), 4294967295) % 20 AS kind FROM spaced, bits),
rows_there AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM kinds, range(2) c(copy) WHERE copy < CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM rows_there),
marked AS (SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut,
        substr(role, 1, 1) AS r, substr(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1, 1) AS r0 FROM numbered),
turns AS (SELECT *, blank OR again AS gone, CASE WHEN NOT blank AND NOT again AND cut THEN 1 ELSE 0 END AS added FROM marked),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
        count(*) FILTER (blank) AS blank, count(*) FILTER (again AND NOT blank) AS duplicate,
        count(*) FILTER (added = 1) AS truncated,
        count(*) FILTER (i > 0 AND r0 || r NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id),
inserts(a, b, more, paid) AS (VALUES ('', '', '', 0), ('s', 's', '', 0), ('u', 'u', '', 0), ('a', 'a', '', 0),
        ('', 'u', 'I', 2), ('s', 'u', 'I', 2), ('u', 'a', 'I', 2), ('a', 'u', 'I', 2),
        ('', 'a', 'II', 4), ('s', 'a', 'II', 4)),
nodes AS (
    SELECT conv_id, 0 AS i, b AS last, {'cost': paid, 'audit': more} AS way FROM counted, inserts WHERE a = ''
    UNION ALL
    SELECT conv_id, any_value(i) + 1, last, min(way) FROM (
        SELECT e.conv_id, e.i, x.b AS last, {'cost': e.cost + x.paid, 'audit': e.audit || x.more} AS way FROM (
            SELECT n.conv_id, n.i, n.last, n.way.cost + 3 AS cost, n.way.audit || 'D' AS audit
                FROM nodes n JOIN turns t ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.i = n.i
            UNION ALL SELECT n.conv_id, n.i, t.r, n.way.cost + t.added, n.way.audit || 'K'
                FROM nodes n JOIN turns t ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.i = n.i
                WHERE NOT t.gone AND (n.last || t.r IN ('su', 'ua', 'au') OR (n.last = '' AND t.r IN ('s', 'u')))
            UNION ALL SELECT n.conv_id, n.i, CASE WHEN n.last = 'u' THEN 'a' ELSE 'u' END, n.way.cost + 2 + t.added, n.way.audit || 'R'
                FROM nodes n JOIN turns t ON t.conv_id IS NOT DISTINCT FROM n.conv_id AND t.i = n.i WHERE NOT t.gone
        ) e JOIN inserts x ON x.a = e.last)
    GROUP BY conv_id, last),
repairs AS (SELECT c.*, w.way.cost AS cost, w.way.audit AS audit FROM counted c JOIN (
        SELECT conv_id, i, min(way) AS way FROM nodes WHERE last IN ('', 'a') GROUP BY conv_id, i
    ) w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n),
places AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM repairs),
edits AS (SELECT conv_id, k, substr(audit, k, 1) AS edit, length(replace(substr(audit, 1, k - 1), 'I', '')) AS i FROM places),
kept AS (SELECT e.conv_id, e.k, e.edit, t.role, CASE WHEN e.edit = 'I' THEN '' ELSE t.text END AS text,
        row_number() OVER (PARTITION BY e.conv_id ORDER BY k) AS place
    FROM edits e LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM e.conv_id AND t.i = e.i WHERE e.edit <> 'D'),
headed AS (SELECT *, max(CASE WHEN place = 1 AND edit = 'K' AND role LIKE 's%' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS head FROM kept),
texts AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - head) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY k) AS whole FROM headed GROUP BY conv_id)
SELECT o.conv_id, coalesce(r.gaps, 0) AS gaps, coalesce(r.blank, 0) AS blank, coalesce(r.duplicate, 0) AS duplicate,
    coalesce(r.truncated, 0) AS truncated, coalesce(r.illegal, 0) AS illegal, CAST(coalesce(r.cost, 0) AS BIGINT) AS cost,
    coalesce(r.audit, '') AS audit, sha256(coalesce(x.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN repairs r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM o.conv_id
"""
