"""Quality rules: an isolation forest over what the rules measure.

The rules measure each whole text (:func:`with_statistics`); each rule's statistic is how far its rate
lies outside the range that labelled good documents keep to (:func:`usual_ranges`, :func:`statistics`).
Random splits of those statistics isolate odd documents after few steps, so a short mean path means
an anomaly (:func:`grow_forest`). Where to draw the line comes from labelled rows too
(:func:`calibrated_threshold`): all labelled documents count, and the line rejects at most
``max_good_loss`` of the good ones. A text that fails a base rule is rejected in any case.

Each tree grows from about ``TREE_ROWS`` rows, as isolation forests do: the ``TREES * TREE_ROWS`` rows
with the smallest seeded hash, dealt to the trees; of a smaller table each row goes to several trees. All
other figures cover all rows.

Defined results: a NULL text counts as empty and fails a base rule; rows that repeat, or share a
doc_id, are each judged alone; labels without a document, or with NULL, are left out, and where
labels of one document differ it counts as good; without labelled junk, or without rows, only the base rules
reject. Further columns pass through; a column named like one that is added stays, the added one
gets a leading underscore in :func:`with_statistics` and replaces it in :func:`judged`'s report.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import fresh_name, staged
from millrace.llm.wordhash import mixed, pieces, windows, words

TREES = 100
TREE_ROWS = 256
SCORE_BINS = 1000
MAX_GOOD_LOSS = 0.0005
RANGE_TAIL = 0.0005
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The marks that count as symbols.
SYMBOLS = "#*$%&|<>"

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_marks", "n_alone",
)
_TABLES = {
    "n_symbols": SYMBOLS.encode(),
    "n_upper": bytes(range(0x41, 0x5B)),
    "n_digits": bytes(range(0x30, 0x3A)),
    "n_marks": b"!?.,;:",
}
_FLAGS = {}
for _name, _members in _TABLES.items():
    _FLAGS[_name] = np.zeros(256, dtype=bool)
    _FLAGS[_name][list(_members)] = True


def _repeated_words(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Per text, how many words lie in a three-word window that the text has twice or more."""
    n, texts = len(hashes), len(firsts) - 1
    if n < 4:
        return np.zeros(texts, np.int64)
    owner = np.repeat(np.arange(texts), np.diff(firsts))
    whole = np.flatnonzero(owner[:-2] == owner[2:])
    keys = windows(hashes, 3)[whole] ^ mixed(owner[whole].astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    alike = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][alike]] = True
    twice[order[:-1][alike]] = True
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[whole[twice] + k] = True
    return np.bincount(owner, weights=covered, minlength=texts).astype(np.int64)


def _line_counts(text: bytes) -> tuple[int, int]:
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\x0b\x0c\r")]
    return len(lines), len(lines) - len(set(lines))


def measure(texts: pa.Array) -> pd.DataFrame:
    """The counts of each whole text (NULL: empty)."""
    parts = []
    for piece in pieces(texts):
        hashes, firsts = words(piece)
        out = {name: piece.per_text(flags[piece.bytes]) for name, flags in _FLAGS.items()}
        out["n_words"] = np.diff(firsts)
        out["word_chars"] = piece.per_text(~piece.space & ((piece.bytes & 0xC0) != 0x80))
        out["n_repeat_words"] = _repeated_words(hashes, firsts)
        # a word of one byte: white space or an edge on both sides
        gap = np.ones(len(piece.bytes) + 2, dtype=bool)
        gap[1:-1] = piece.space
        alone = gap[:-2] & gap[2:] & ~piece.space
        out["n_alone"] = piece.per_text(alone)
        body = piece.bytes.tobytes()
        lines = [_line_counts(body[a:b]) for a, b in zip(piece.begins[:-1], piece.begins[1:], strict=True)]
        out["n_lines"], out["n_dup_lines"] = np.array(lines, dtype=np.int64).reshape(-1, 2).T
        parts.append(pd.DataFrame(out))
    found = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=list(COUNTS))
    return found[list(COUNTS)].astype("int64")


def _measured(texts: pa.Array) -> pa.Array:
    found = measure(texts)
    return pa.StructArray.from_arrays([pa.array(found[c].to_numpy(), pa.int64()) for c in COUNTS], list(COUNTS))


def with_statistics(docs: DataFrame, text: str = "text", name: str = "measures") -> tuple[DataFrame, str]:
    """The rows with a struct of counts, and the struct's name."""
    name = fresh_name(docs, name)
    counts = F.arrow_udf(_measured, "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">")
    return docs.withColumn(name, counts(F.col(f"`{text}`"))), name


def base_failed(measures: str) -> Column:
    n, repeated = F.col(f"`{measures}`.n_words"), F.col(f"`{measures}`.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def rates(measures: str) -> list[Column]:
    """What the rules look at: rates, so that a text's length alone is no anomaly."""
    part = lambda a, b: F.col(f"`{measures}`.{a}") / F.greatest(F.col(f"`{measures}`.{b}"), F.lit(1))
    return [
        part("word_chars", "n_words"), part("n_symbols", "n_words"), part("n_dup_lines", "n_lines"),
        part("n_repeat_words", "n_words"), part("n_upper", "word_chars"), part("n_digits", "word_chars"),
        part("n_marks", "n_words"), part("n_alone", "n_words"),
    ]


def _known(labels: DataFrame) -> DataFrame:
    """One row per labelled document."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))


def usual_ranges(measured: DataFrame, measures: str, labels: DataFrame, tail: float = RANGE_TAIL) -> list[tuple[float, float]]:
    """Between which values each rate of the labelled good documents lies, but for ``tail`` on either side.

    Without such documents, those of all rows.
    """
    passed = measured.where(~base_failed(measures))
    good = passed.join(_known(labels).where("quality > 0").select("doc_id"), "doc_id")
    ends = [F.percentile_approx(r, [tail, 1 - tail], 20_000).alias(f"r{i}") for i, r in enumerate(rates(measures))]
    for rows in (good, passed):
        found = rows.agg(*ends).first()
        if found.r0 is not None:
            return [(low, high) for low, high in found]
    return []


def statistics(measures: str, ranges: list[tuple[float, float]]) -> list[Column]:
    """What the trees split on: how far each rate lies outside its usual range."""
    return [
        F.greatest(rate - F.lit(high), F.lit(low) - rate, F.lit(0.0))
        for rate, (low, high) in zip(rates(measures), ranges, strict=False)
    ]


def expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, dtype=float)
    many = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(many - 1) + np.euler_gamma) - 2 * (many - 1) / many, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Nodes of all trees, a tree after the other; ``feature`` -1 marks a leaf."""

    roots: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    length: np.ndarray
    rows: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """From 0 (ordinary) to 1 (isolated at once)."""
        if not len(self.roots):
            return np.zeros(len(rows))
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            moving = every
            while len(moving):
                node = at[moving]
                inner = self.feature[node] >= 0
                moving, node = moving[inner], node[inner]
                low = rows[moving, self.feature[node]] < self.split[node]
                at[moving] = np.where(low, self.left[node], self.right[node])
            total += self.length[at]
        return np.exp2(-total / len(self.roots) / max(float(expected_path(self.rows)), 1e-9))


def _grow(rows: np.ndarray, random: np.random.Generator) -> list[tuple]:
    """One tree as (feature, split, left, right, path length) with positions within the tree."""
    limit = int(np.ceil(np.log2(max(len(rows), 2))))
    nodes: list[list] = [[-1, 0.0, -1, -1, 0.0]]
    open_nodes = [(0, rows, 0)]
    while open_nodes:
        at, part, depth = open_nodes.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(usable):
            nodes[at][4] = depth + float(expected_path(len(part)))
            continue
        feature = int(random.choice(usable))
        split = float(random.uniform(low[feature], high[feature])) or float(high[feature])
        below = part[:, feature] < split
        if not below.any() or below.all():
            split = float(high[feature])
            below = part[:, feature] < split
        nodes[at][:4] = [feature, split, len(nodes), len(nodes) + 1]
        open_nodes += [(len(nodes), part[below], depth + 1), (len(nodes) + 1, part[~below], depth + 1)]
        nodes += [[-1, 0.0, -1, -1, 0.0], [-1, 0.0, -1, -1, 0.0]]
    return [tuple(x) for x in nodes]


def grow_forest(
    points: DataFrame, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7
) -> Forest:
    """Grow each tree in a task of its own from its share of the sample.

    ``points`` has doc_id and the statistics, which the rows with the smallest seeded hash give.
    """
    columns = [c for c in points.columns if c != "doc_id"]
    if not columns:
        return Forest(*[np.empty(0, int)] * 6, 0)
    sample = points.withColumn("dealt", F.xxhash64(F.lit(seed), "doc_id")).drop("doc_id").orderBy("dealt").limit(trees * tree_rows)
    copies = min(trees, -(-trees * tree_rows // max(points.count(), 1)))
    dealt = sample.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn(
        "tree", F.pmod(F.hash("dealt") + F.col("tree"), F.lit(trees))
    )

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["dealt", *columns])
        tree = int(part["tree"].iloc[0])
        nodes = _grow(part[columns].to_numpy(float), np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["feature", "split", "left", "right", "length"])
        return out.assign(tree=tree, node=range(len(out)), rows=len(part))

    schema = "feature int, split double, left int, right int, length double, tree int, node int, rows int"
    grown = dealt.groupBy("tree").applyInPandas(grow, schema).toPandas().sort_values(["tree", "node"])
    roots = np.flatnonzero(grown["node"].to_numpy() == 0)
    base = np.repeat(roots, np.diff([*roots, len(grown)])) if len(roots) else np.empty(0, int)
    sizes = grown["rows"].to_numpy()[roots]
    return Forest(
        roots, grown["feature"].to_numpy(), grown["split"].to_numpy(),
        grown["left"].to_numpy() + base, grown["right"].to_numpy() + base, grown["length"].to_numpy(),
        int(sizes.mean()) if len(sizes) else 0,
    )


def scored(rows: DataFrame, statistics: list[Column], forest: Forest, name: str = "anomaly") -> DataFrame:
    """The rows with their anomaly score."""
    if not statistics:
        return rows.withColumn(name, F.lit(0.0))
    held = rows.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(*parts: pd.Series) -> pd.Series:
        return pd.Series(held.value.scores(np.column_stack([p.to_numpy(float) for p in parts])))

    return rows.withColumn(name, score(*statistics))


def calibrated_threshold(
    graded: DataFrame, labels: DataFrame, max_good_loss: float = MAX_GOOD_LOSS, bins: int = SCORE_BINS
) -> float:
    """The score from which on a document is rejected.

    ``graded`` has doc_id and score of every text that passed the base rules. Of the lines that lose
    at most ``max_good_loss`` of the good labelled rows, those that catch most labelled junk, and of
    these the highest; 2 (nothing is rejected) without junk.
    """
    counts = (
        graded.join(_known(labels), "doc_id")
        .groupBy(F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).alias("bin"))
        .agg(F.sum(F.when(F.col("quality") > 0, 1).otherwise(0)).alias("good"), F.count("*").alias("n"))
        .collect()
    )
    good, junk = np.zeros(bins), np.zeros(bins)
    for row in counts:
        good[row.bin], junk[row.bin] = row.good, row.n - row.good
    if not junk.sum():
        return 2.0
    lost, caught = np.cumsum(good[::-1])[::-1], np.cumsum(junk[::-1])[::-1]
    allowed = np.flatnonzero((lost <= max_good_loss * good.sum()) & (caught > 0))
    if not len(allowed):
        return 2.0
    return float(allowed[caught[allowed] == caught[allowed[0]]][-1] / bins)


def judged(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """The rows (columns ``keep``, or all) with a struct: the counts, base_failed, anomaly and kept.

    The texts are measured once; the measures are staged with the columns that go on.
    """
    measured, measures = with_statistics(docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys(["doc_id", "text", *(keep or docs.columns)])]))
    if keep is not None and "text" not in keep:
        measured = measured.drop("text")
    measured = staged(measured, "quality")
    found = statistics(measures, usual_ranges(measured, measures, labels))
    points = measured.where(~base_failed(measures))
    forest = grow_forest(points.select("doc_id", *[x.alias(f"s{i}") for i, x in enumerate(found)]))
    score = fresh_name(measured, "anomaly")
    graded = scored(measured, found, forest, score)
    passed = graded.where(~base_failed(measures))
    line = calibrated_threshold(passed.select("doc_id", F.col(f"`{score}`").alias("score")), labels)
    verdict = F.struct(
        F.col(f"`{measures}`.*"),
        base_failed(measures).alias("base_failed"),
        F.col(f"`{score}`").alias("anomaly"),
        (~base_failed(measures) & (F.col(f"`{score}`") < line)).alias("kept"),
    )
    return graded.withColumn(measures, verdict).drop(score), measures


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and the anomaly score of every row."""
    rows, verdict = judged(docs, labels, keep=["doc_id"])
    return rows.select("doc_id", F.col(f"`{verdict}`.*"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that pass, with their columns."""
    rows, verdict = judged(docs, labels)
    return rows.where(F.col(f"`{verdict}`.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
