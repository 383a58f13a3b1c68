"""Periodic runs of words, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` that is at least ``least`` words and
``times`` periods long, and that no neighbouring word extends. Per text:

1. Words whose windows of eight words do not come again near by cannot lie in a run (:func:`stretches`);
   for most texts that is all of them, and nothing more happens.
2. What is left is read word by word into a suffix automaton (:class:`Automaton`), whose suffix links form
   a tree: the path from a prefix's node to the root has all suffixes of the prefix.
3. Word after word, the path of the prefix that now ends is accessed (:class:`LastEnds`) in a link-cut
   forest, whose preferred paths hold the suffixes that ended last at the same place, and recoloured with
   the new end. A segment of the path that ended last at ``p``, its longest suffix having ``m`` words,
   shows that ``m`` words come again ``i - p`` later: with ``i - p <= m`` they form a square of that period.
4. Squares are extended word by word to both sides (:func:`runs_of`). A smaller period would have brought
   the suffix back earlier, so the period found is the smallest.

Accesses change O(n log n) segments in all, and each run is extended once. Each text is judged alone and
whole in the task that reads it; nothing is shuffled. Words are runs of characters other than space and
0x09-0x0D. A NULL or empty text has no words and no runs; rows that repeat are each judged; all columns
go on, and one that is named like the added column makes that one take a leading underscore.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import fresh_name
from millrace.llm.wordhash import pieces, windows, words

LEAST_WORDS = 24
LEAST_TIMES = 3

Run = tuple[int, int, int]


class Automaton:
    """Suffix automaton of a sequence; ``prefix[i]`` is the state of the first i + 1 words."""

    def __init__(self, sequence: list):
        self.link = [-1]
        self.length = [0]
        self.prefix = []
        self.steps: list[dict] = [{}]
        last = 0
        for word in sequence:
            last = self._append(word, last)
            self.prefix.append(last)

    def _append(self, word, last: int) -> int:
        link, length, steps = self.link, self.length, self.steps
        new = len(link)
        link.append(0)
        length.append(length[last] + 1)
        steps.append({})
        at = last
        while at >= 0 and word not in steps[at]:
            steps[at][word] = new
            at = link[at]
        if at >= 0:
            known = steps[at][word]
            if length[known] == length[at] + 1:
                link[new] = known
            else:
                split = len(link)
                link.append(link[known])
                length.append(length[at] + 1)
                steps.append(dict(steps[known]))
                while at >= 0 and steps[at].get(word) == known:
                    steps[at][word] = split
                    at = link[at]
                link[known] = link[new] = split
        return new


class LastEnds:
    """Where the suffixes on each root path ended last: a link-cut forest over the suffix links.

    Each preferred path is a splay tree by depth; its colour, the last end, is kept at the tree's root.
    """

    def __init__(self, link: list[int], length: list[int]):
        self.up = list(link)  # the parent in the splay tree, or above the path's top
        self.left = [-1] * len(link)
        self.right = [-1] * len(link)
        self.colour = [-1] * len(link)
        self.length = length

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            self._rotate(x)

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            inner = right[x]
            left[p], right[x] = inner, p
        else:
            inner = left[x]
            right[p], left[x] = inner, p
        if inner >= 0:
            up[inner] = p
        up[p], up[x] = x, g
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x
        self.colour[x] = self.colour[p]

    def access(self, node: int, end: int) -> list[tuple[int, int]]:
        """(last end, longest suffix) of each segment of the path from a node to the root, the longest
        first; afterwards all its suffixes end at ``end``."""
        found = []
        up, left, right, colour, length = self.up, self.left, self.right, self.colour, self.length
        below, x = -1, node
        while x >= 0:
            self._splay(x)
            if colour[x] >= 0 and length[x]:
                found.append((colour[x], length[x]))
            deeper = right[x]
            if deeper >= 0:
                colour[deeper] = colour[x]
            right[x] = below
            below, x = x, up[x]
        # ``below`` is the root of the tree that now holds the whole path.
        colour[below] = end
        return found


def runs_of(sequence: list, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    n = len(sequence)
    automaton = Automaton(sequence)
    ends = LastEnds(automaton.link, automaton.length)
    reached: dict[int, int] = {}  # per period, where its last run ends
    found = []
    for i, node in enumerate(automaton.prefix):
        for last, longest in ends.access(node, i):
            period = i - last
            if period > longest or reached.get(period, -1) >= i:
                continue
            start, stop = i - longest - period + 1, i + 1
            while start > 0 and sequence[start - 1] == sequence[start - 1 + period]:
                start -= 1
            while stop < n and sequence[stop] == sequence[stop - period]:
                stop += 1
            reached[period] = stop - 1
            if stop - start >= max(least, times * period):
                found.append((start, stop - start, period))
    return sorted(found, key=lambda r: (r[0], r[2]))


def window_words(least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> int:
    """A width such that every window inside a run comes again in the run a period later or earlier.

    A run of L words, L >= least and L >= times * q, leaves L - 2q + 1 > least * (times - 2) / times words.
    """
    return least * (times - 2) // times + 1


def stretches(hashes: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[tuple[int, int]]:
    """The stretches of a text that can hold a run; ``hashes`` has one per word.

    All windows inside a run have their like a period away, which is at most a ``times``-th of the run and
    so of the stretch. Windows without such a like break stretches until none does any more.
    """
    width = window_words(least, times)
    n = len(hashes)
    if n < least:
        return []
    keys = windows(hashes, width)
    order = np.argsort(keys, kind="stable")
    alike = keys[order][1:] == keys[order][:-1]
    far = np.iinfo(np.int64).max
    nearest = np.full(len(keys), far)
    gaps = np.where(alike, np.diff(order), far)
    nearest[order[1:]] = gaps
    nearest[order[:-1]] = np.minimum(nearest[order[:-1]], gaps)
    good = nearest < far
    while True:
        edges = np.flatnonzero(np.diff(np.concatenate(([0], good.astype(np.int8), [0]))))
        begins, ends = edges[::2], edges[1::2]
        lengths = ends - begins + width - 1
        keep = lengths >= least
        begins, ends, lengths = begins[keep], ends[keep], lengths[keep]
        allowed = np.zeros(len(keys), dtype=np.int64)
        for b, e, length in zip(begins.tolist(), ends.tolist(), lengths.tolist(), strict=True):
            allowed[b:e] = length // times
        still = good & (nearest <= allowed)
        if np.array_equal(still, good):
            return [(b, e + width - 1) for b, e in zip(begins.tolist(), ends.tolist(), strict=True)]
        good = still


def text_runs(body: list[bytes], hashes: np.ndarray, least: int = LEAST_WORDS, times: int = LEAST_TIMES) -> list[Run]:
    """The runs of a text's words, by start, then period."""
    found = []
    for begin, end in stretches(hashes, least, times):
        # Stretches may share words at their edges, but a run lies wholly in one of them.
        found += [(begin + s, length, q) for s, length, q in runs_of(body[begin:end], least, times)]
    return sorted(set(found), key=lambda r: (r[0], r[2]))


def collapsed(body: list[bytes], runs: list[Run]) -> bytes:
    """The words that stay when of each run only the first period does, joined by one space."""
    if not runs:
        return b" ".join(body)
    gone = np.zeros(len(body) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return b" ".join([w for w, n in zip(body, np.cumsum(gone)[:-1].tolist(), strict=True) if not n])


RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"
_ARROW_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _results(texts: pa.Array, least: int, times: int) -> Iterator[tuple[int, list[dict], bytes]]:
    for piece in pieces(texts):
        hashes, firsts = words(piece)
        data = piece.bytes.tobytes()
        for k in range(piece.texts):
            body = data[piece.begins[k] : piece.begins[k + 1]].split()
            runs = text_runs(body, hashes[firsts[k] : firsts[k + 1]], least, times)
            yield len(body), [{"start": s, "length": n, "period": q} for s, n, q in runs], collapsed(body, runs)


def with_runs(
    docs: DataFrame, text: str = "text", name: str = "periodic", least: int = LEAST_WORDS, times: int = LEAST_TIMES
) -> tuple[DataFrame, str]:
    """The rows with a struct of the number of words, the runs and the collapsed text, and its name."""
    name = fresh_name(docs, name)

    def found(texts: pa.Array) -> pa.Array:
        rows = list(_results(texts, least, times))
        counts, runs, rest = ([r[i] for r in rows] for i in range(3))
        arrays = [pa.array(counts, pa.int64()), pa.array(runs, _ARROW_RUNS), pa.array(rest, pa.binary()).cast(pa.string())]
        return pa.StructArray.from_arrays(arrays, ["n_words", "runs", "collapsed"])

    return docs.withColumn(name, F.arrow_udf(found, RESULT)(F.col(f"`{text}`"))), name


def without_repetition(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the repetitions of runs taken out of their texts; a text without runs stays as it is."""
    rows, name = with_runs(docs, text)
    found = F.col(f"`{name}`")
    return rows.withColumn(text, F.when(F.size(found.runs) > 0, found.collapsed).otherwise(F.col(f"`{text}`"))).drop(name)


def strongest(runs: Column) -> Column:
    """The run with the greatest length by period (ties: smallest start, then period); NULL without runs.

    Compared by products, so without rounding.
    """
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")

    def stronger(best: Column, run: Column) -> Column:
        # Runs come by start, then period, so the earlier one wins a tie.
        better = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(better, run).otherwise(best)

    return F.aggregate(runs, none, stronger)


def repeating(doc_id: int | None, text: str | None) -> str | None:
    """The text of a document, or for every tenth one its words with a stretch that repeats itself up to
    the end; which, from where and with what period follows from the id's checksum. A NULL id changes nothing."""
    body = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not body:
        return text
    g, n = h // 10, len(body)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = body[a : a + p]
    return b" ".join((body[:a] + part * ((n - a) // p + 1))[:n]).decode()


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of the documents, with repetition in every tenth."""

    def changed(ids: pa.Array, texts: pa.Array) -> pa.Array:
        return pa.array([repeating(i, t) for i, t in zip(ids.to_pylist(), texts.to_pylist(), strict=True)], pa.string())

    return docs.select("doc_id", F.arrow_udf(changed, "string")("doc_id", "text").alias("text"))


def runs_report(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the number of runs, the strongest one, and digests of all runs and of what is left."""
    rows, name = with_runs(docs.select("doc_id", "text"))
    found = F.col(name)
    best = strongest(found.runs)
    lines = F.transform(found.runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.withColumn("best", best).select(
        "doc_id",
        F.size(found.runs).cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(found.collapsed.cast("binary"), 256).alias("collapsed_sha256"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return runs_report(planted(spark.read.parquet(f"{folder}/documents.parquet")))
