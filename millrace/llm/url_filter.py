"""URL filters: rules by host and path, and a character language model for the URLs no rule decides.

Two variable-order Markov models are counted, from accepted and from rejected URLs (those that a rule
decides). A character's probability after two others is interpolated with those after one and after
none, by how many different characters followed each context (Witten-Bell); an unseen context falls back to
the shorter one. A URL's score is the mean log ratio of its characters' probabilities under the two
models, and the line it has to reach is calibrated: of ``SCORE_BINS`` lines the one with the smallest mean
error of both classes among decided URLs that the models were not counted from (a seeded hash picks
``HELD_OUT`` sixteenths of them). So all URLs take part in the counts or in the calibration.

Characters are folded to ``SYMBOLS`` kinds, so a model has ``SYMBOLS ** 3`` numbers at any size of the
input: they go into the scoring expression as one constant of two bytes a number. Only DataFrame functions
are used.

Defined results: a NULL URL, or one without ``://``, has an empty host and path and fits no rule; an empty
or NULL URL has no character, score 0; rows are judged one by one, repeated rows count as often as they
occur; without rows of a class its model is uniform, without held-out rows the line is 0; a score on
the line is allowed. Further columns pass through :func:`judged`.
"""

from __future__ import annotations

import string
import sys
from array import array
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.staging import fresh_name

# Host and path with the verdict, in any order; the longest that fits wins.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
SYMBOLS = 32
START = SYMBOLS - 1
OTHER = SYMBOLS - 2
MARKS = "0./-"  # symbols behind the letters; all digits are "0"
# A log ratio r is written as round((r + RATIO_REACH) * RATIO_STEPS), in 16 bits.
RATIO_REACH, RATIO_STEPS = 16.0, 2000
SCORE_BINS = 400
SCORE_REACH = 5.0
HELD_OUT = 3


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3))
    lowered = F.translate(F.coalesce(F.regexp_substr(rest, F.lit("^[^/?#]*")), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lowered, F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        own, _, start = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(f"/{start}"))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def symbols(url: Column) -> Column:
    """Numbers of a URL's characters, behind two that mark its start."""
    lowered = F.translate(F.coalesce(url, F.lit("")), string.ascii_uppercase + string.digits, string.ascii_lowercase + "0" * 10)
    marks = F.lit(OTHER)
    code = lambda c: F.when((F.ascii(c) >= 97) & (F.ascii(c) <= 122), F.ascii(c) - 97)

    def number(c):
        out = code(c)
        for i, mark in enumerate(MARKS):
            out = out.when(c == mark, F.lit(26 + i))
        return out.otherwise(marks)

    characters = F.when(F.length(lowered) > 0, F.transform(F.split(lowered, ""), number)).otherwise(F.expr("cast(array() as array<int>)"))
    return F.concat(F.array(F.lit(START), F.lit(START)), characters)


def contexts(numbers: Column) -> Column:
    """Per character the number of it and the two before it."""


    def triples(known):
        at = lambda i: F.get(known, i)
        places = F.sequence(F.lit(0), F.size(known) - 3)
        found = F.transform(places, lambda i: (at(i) * SYMBOLS + at(i + 1)) * SYMBOLS + at(i + 2))
        return F.when(F.size(known) > 2, found).otherwise(F.expr("cast(array() as array<int>)"))

    return _once(numbers, triples)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def constant(ratio: Sequence[float]) -> Column:
    """The model as a binary constant."""
    steps = array("H", [min(max(round((x + RATIO_REACH) * RATIO_STEPS), 0), 0xFFFF) for x in ratio])
    if sys.byteorder == "little":
        steps.byteswap()
    return F.lit(steps.tobytes())


def _log_probability(counts: DataFrame, name: str) -> list[Column]:
    """Log probability of the last of three symbols, from the class's counts ``name`` of all triples."""
    n = F.col(name)
    over = lambda *keys: Window.partitionBy(*keys)
    pairs = F.sum(n).over(over("b", "c"))
    first = F.col("a") == 0  # one row for each pair
    total, single = F.sum(n).over(over("all")), F.sum(n).over(over("c"))
    p0 = (single + 1) / (total + SYMBOLS)
    n1, t1 = F.sum(n).over(over("b")), F.sum(F.when(first & (F.col(f"{name}_pairs") > 0), 1).otherwise(0)).over(over("b"))
    n2, t2 = F.sum(n).over(over("a", "b")), F.sum(F.when(n > 0, 1).otherwise(0)).over(over("a", "b"))
    p1 = F.when(n1 > 0, (F.col(f"{name}_pairs") + t1 * p0) / (n1 + t1)).otherwise(p0)
    p2 = F.when(n2 > 0, (n + t2 * p1) / (n2 + t2)).otherwise(p1)
    return [pairs.alias(f"{name}_pairs"), F.ln(p2)]


def ratios(rows: DataFrame) -> DataFrame:
    """One row: ``ratio``, for each triple of symbols the log ratio of accepted to rejected.

    ``rows`` has ``triples`` and ``verdict``. Behind the counts everything has a fixed size.
    """
    triples = rows.select("verdict", F.explode("triples").alias("triple")).groupBy("triple").agg(
        F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("bad"),
    )
    every = rows.sparkSession.range(0, SYMBOLS**3, 1, 1).select(F.col("id").cast("int").alias("triple"))
    counts = every.join(triples, "triple", "left").select(
        "triple", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("bad", F.lit(0)).alias("bad"),
        F.floor(F.col("triple") / SYMBOLS**2).alias("a"), F.floor(F.col("triple") / SYMBOLS % SYMBOLS).alias("b"),
        (F.col("triple") % SYMBOLS).alias("c"), F.lit(0).alias("all"),
    )
    names = ("good", "bad")
    paired = counts.select("*", *[_log_probability(counts, n)[0] for n in names])
    logs = paired.select("triple", *[_log_probability(paired, n)[1].alias(n) for n in names])
    listed = F.array_sort(F.collect_list(F.struct("triple", (F.col("good") - F.col("bad")).alias("ratio"))))
    return logs.agg(F.transform(listed, lambda x: x["ratio"]).alias("ratio"))


def score(triples: Column, ratio: Column) -> Column:
    """Mean log ratio per character by the model's constant; 0 without any."""
    steps = lambda t: F.conv(F.hex(F.substring(ratio, t * 2 + 1, F.lit(2))), 16, 10).cast("bigint")

    def mean(known):
        total = F.aggregate(known, F.lit(0).cast("bigint"), lambda s, t: s + steps(t))
        return F.when(F.size(known) > 0, total / F.size(known) / RATIO_STEPS - RATIO_REACH).otherwise(F.lit(0.0))

    return _once(triples, mean)


def line_of(rows: DataFrame) -> DataFrame:
    """One row: ``line``, from the scores of held-out rows with verdicts."""
    bins = F.least(F.greatest(F.floor((F.col("score") + SCORE_REACH) / (2 * SCORE_REACH) * SCORE_BINS), F.lit(0)), F.lit(SCORE_BINS - 1))
    sums = rows.groupBy(bins.alias("bin")).agg(
        F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("bad"),
    )
    below = Window.partitionBy(F.lit(0)).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    lost = F.coalesce(F.sum("good").over(below), F.lit(0)) / F.greatest(F.sum("good").over(whole), F.lit(1))
    passed = 1 - F.coalesce(F.sum("bad").over(below), F.lit(0)) / F.greatest(F.sum("bad").over(whole), F.lit(1))
    errors = sums.select("bin", (lost + passed).alias("error"), F.sum("good").over(whole).alias("good"), F.sum("bad").over(whole).alias("bad"))
    best = F.min_by(F.struct("bin"), F.struct("error", F.abs(F.col("bin") - SCORE_BINS // 2)))["bin"]
    return errors.where("good > 0 and bad > 0").agg(F.coalesce(best / SCORE_BINS * 2 * SCORE_REACH - SCORE_REACH, F.lit(0.0)).alias("line"))


def judged(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> tuple[DataFrame, str]:
    """The rows with a struct of host, path, rule, verdict and score, and its name."""
    name = fresh_name(pages, "filter")
    address = F.col(f"`{url}`")
    host, path = host_and_path(address)
    ruled = pages.withColumn(name, F.struct(host.alias("host"), path.alias("path")))
    rule, verdict = rule_of(F.col(f"`{name}`.host"), F.col(f"`{name}`.path"), rules)
    ruled = ruled.withColumn(name, F.struct(F.col(f"`{name}`.*"), rule.alias("rule"), verdict.alias("verdict")))

    decided = ruled.where(F.col(f"`{name}`.verdict").isNotNull()).select(
        F.col(f"`{name}`.verdict").alias("verdict"), contexts(symbols(address)).alias("triples"),
        (F.conv(F.substring(F.md5(address), 1, 1), 16, 10).cast("int") < HELD_OUT).alias("held_out"),
    )
    # a subquery may not stand within a lambda function; both results have a fixed size
    model = ratios(decided.where(~F.col("held_out"))).first().ratio
    ratio = constant(model)
    line = F.lit(line_of(decided.where("held_out").select("verdict", score(F.col("triples"), ratio).alias("score"))).first().line)
    graded = ruled.withColumn(name, F.struct(F.col(f"`{name}`.*"), score(contexts(symbols(address)), ratio).alias("score")))
    says = F.coalesce(F.col(f"`{name}`.verdict"), F.when(F.col(f"`{name}`.score") >= line, "allow").otherwise("block"))
    return graded.withColumn(name, F.col(f"`{name}`").withField("verdict", says)), name


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows, verdict = judged(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url"))
    return rows.select("page_id", f"`{verdict}`.*")
