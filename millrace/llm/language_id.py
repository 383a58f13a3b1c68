"""Language identification by Bayesian fusion of evidence.

The posterior of a language is the product of

* the text's likelihood: counts of hashed byte triples by language, from all rows that declare one of
  the languages (:func:`train`). Neighbouring triples are not independent, so a text's evidence is its
  mean per triple, counted for at most ``EVIDENCE_TRIPLES`` triples;
* how often rows of that language declare what the row declares in its markup (or its own column);
* how often rows of that language have the last label of the row's address;
* the prior of its host, smoothed towards that of the domain above it, and that towards all rows.

The last three come from grouped aggregations of what the texts alone say, over all rows
(:func:`evidence_tables`); they are partial sums per key, so a key with a third of the rows is no burden.

The languages are those that enough rows declare (:func:`languages_of`). Next to them stands ``OTHER``, for which
all triples are equally likely: noise, and text whose tag is too rare to learn from, come nearer to it.

A row that declares a language too rare to learn has that language, unless its text is found to be in a learnt
one; with any text it is kept. Of the others a row is rejected if its text has no triple, if no language reaches ``LEAST_POSTERIOR``, if that language is
``OTHER``, or if its text is unlike the language: if its mean per triple is below the middle between the
median of all rows that declare and resemble the language, and that of ``OTHER``, by more than ``ERRORS``
standard errors of a text with so many triples (each byte is in three of them).

Defined results: a NULL text is empty; empty texts are identified by their other evidence and
rejected; NULL or empty declarations and addresses are no evidence; rows that repeat are each judged
and all counted; without any row of a language its share is that of the smoothing. Further columns pass
through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.html_text import extracted
from millrace.llm.staging import fresh_name, staged, text_batches
from millrace.llm.wordhash import Piece, pieces
from millrace.operators.joins import broadcast_if_small

OTHER = "other"
# A language has so many rows and characters, or that share of a small table's. Of more languages than the model
# takes (256 KB each) those with most text are learnt; rows of the others pass with their tag.
LEAST_ROWS, LEAST_CHARACTERS, SMALL_SHARE, MOST_LANGUAGES = 5, 10_000, 0.1, 250
# Tags that name no language.
NO_LANGUAGES = ("und", "mul", "zxx", "mis", OTHER)
ERRORS = 3.0
# The part of any text that may be names, numbers or quotations: else unseen triples count the more, the larger the table.
UNSEEN = 0.1
BUCKET_BITS = 15
EVIDENCE_TRIPLES = 200
SMOOTHING = 0.5
# Rows that the level above counts for when a host's or domain's shares are estimated.
PRIOR_ROWS = 20.0
LEAST_POSTERIOR = 0.6

# Letters in lower case, all other ASCII as space, bytes of other characters as they are.
_FOLDED = np.full(256, 0x20, dtype=np.uint8)
_FOLDED[0x61:0x7B] = _FOLDED[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLDED[0x80:] = np.arange(0x80, 0x100)


def _triples(piece: Piece) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the triples that hold a letter, and per text where its triples begin."""
    body = _FOLDED[piece.bytes]
    n = len(body) - 2
    if n <= 0:
        return np.empty(0, np.int64), np.zeros(len(piece.begins), np.int64)
    wide = body.astype(np.uint32)
    code = wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]
    whole = np.ones(n, dtype=bool)
    edges = piece.begins[1:-1]
    for k in (1, 2):  # a triple does not reach into the next text
        at = edges - k
        whole[at[(at >= 0) & (at < n)]] = False
    whole &= body[1:-1] != 0x20
    buckets = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    before = np.concatenate(([0], np.cumsum(whole)))
    return buckets[whole].astype(np.int64), before[np.minimum(piece.begins, n)]


def _counter(languages: Sequence[str]):
    """A task that counts its triples by declared language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 1 << BUCKET_BITS
        totals: dict[int, np.ndarray] = {}
        numbers = {name: i for i, name in enumerate(languages)}
        for batch in batches:
            declared = np.array([numbers.get(x, -1) for x in batch.column(0).to_pylist()])
            for piece in pieces(batch.column(1)):
                buckets, firsts = _triples(piece)
                of = declared[piece.first : piece.first + piece.texts]
                owner = np.repeat(of, np.diff(firsts))
                for language in np.unique(of[of >= 0]).tolist():  # only those of the piece, however many there are
                    counts = np.bincount(buckets[owner == language], minlength=size)
                    totals[language] = totals[language] + counts if language in totals else counts
        for language, counts in totals.items():
            bucket = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(bucket), language, np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[bucket])],
                names=["language", "bucket", "n"],
            )

    return run


def languages_of(rows: DataFrame, text: str, declared: Column) -> tuple[str, ...]:
    """The declared languages with enough text to learn from, and ``OTHER`` for all else."""
    texts = rows.select(declared.alias("tag"), F.length(f"`{text}`").alias("size")).where("tag is not null and size > 0")
    tags = staged(texts.groupBy("tag").agg(F.count("*").alias("n"), F.sum("size").alias("size")), "tags")
    n, size = (x or 0 for x in tags.agg(F.sum("n"), F.sum("size")).first())
    enough = (F.col("n") >= min(LEAST_ROWS, SMALL_SHARE * n)) & (F.col("size") >= min(LEAST_CHARACTERS, SMALL_SHARE * size))
    known = tags.where(enough & ~F.col("tag").isin(*NO_LANGUAGES))
    found = known.orderBy(F.desc("size"), "tag").limit(MOST_LANGUAGES).collect()
    return (*sorted(r["tag"] for r in found), OTHER)


def train(rows: DataFrame, text: str, declared: Column, languages: Sequence[str]) -> np.ndarray:
    """Log likelihoods [language, bucket]: a table of fixed size, whatever the number of rows."""
    texts = rows.select(declared.alias("declared"), F.col(f"`{text}`").alias("text"))
    counted = texts.mapInArrow(_counter(languages), "language int, bucket int, n bigint")
    with text_batches(rows.sparkSession):
        sums = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.full((len(languages), 1 << BUCKET_BITS), SMOOTHING)
    counts[sums["language"].to_numpy(int), sums["bucket"].to_numpy(int)] += sums["n"].to_numpy(float)
    return np.log((1 - UNSEEN) * counts / counts.sum(axis=1, keepdims=True) + UNSEEN / counts.shape[1])


def _text_evidence(model):
    def run(texts: pa.Array) -> pa.Array:
        table = model.value
        triples, scores = [], []
        for piece in pieces(texts):
            buckets, firsts = _triples(piece)
            n = np.diff(firsts)
            weight = np.minimum(n, EVIDENCE_TRIPLES) / np.maximum(n, 1)
            owner = np.repeat(np.arange(piece.texts), n)
            sums = [np.bincount(owner, weights=row[buckets], minlength=piece.texts) * weight for row in table]
            triples.append(n)
            scores.append(np.array(sums).T)
        n = np.concatenate(triples) if triples else np.empty(0, np.int64)
        flat = np.concatenate(scores).ravel() if scores else np.empty(0)
        offsets = pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(table))
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(flat))], ["triples", "scores"])

    return run


def _once(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)``, where a lambda in ``of`` gets the value and does not compute it for each of its elements."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def normalised(scores: Column) -> Column:
    """Probabilities from log scores, in time that grows with their number."""
    powers = _once(F.array_max(scores), lambda top: F.transform(scores, lambda x: F.exp(x - top)))
    total = lambda values: F.aggregate(values, F.lit(0.0), lambda a, b: a + b)
    return _once(powers, lambda values: _once(total(values), lambda n: F.transform(values, lambda x: x / n)))


def primary_tag(declared: Column) -> Column:
    """``en`` for ``en-US``; NULL for nothing."""
    tag = F.lower(F.regexp_extract(F.trim(declared), "^([A-Za-z]+)", 1))
    return F.when(tag != "", tag)


def markup_language(html: Column) -> Column:
    """What a page's markup declares: the html tag's language, else that of a content-language meta tag."""
    value = r"""\s*=\s*["']?\s*([A-Za-z][A-Za-z0-9_-]*)"""
    tag = F.regexp_extract(html, r"(?i)<html\b[^>]*?\s(?:xml:)?lang" + value, 1)
    meta = F.regexp_extract(html, r"""(?i)<meta\b(?=[^>]*?http-equiv\s*=\s*["']?content-language)[^>]*?\scontent""" + value, 1)
    return F.when(tag != "", tag).when(meta != "", meta)


def host_of(address: Column) -> Column:
    """The host of a URL, or the address itself if it has no scheme; NULL for nothing."""
    host = F.lower(F.regexp_extract(address, r"^(?:[^:/?#]*://)?([^/?#]*)", 1))
    return F.when(host != "", host)


def _sums(evidence: DataFrame, key: str, languages: Sequence[str]) -> DataFrame:
    shares = [F.sum(F.col("shares")[i]).alias(f"s{i}") for i in range(len(languages))]
    return evidence.where(f"{key} is not null").groupBy(key).agg(*shares)


def evidence_tables(evidence: DataFrame, languages: Sequence[str]) -> dict[str, DataFrame]:
    """For each declaration, suffix and host its log weight by language.

    ``evidence`` has declared, suffix, domain, host and shares (what the text alone says) of all rows.
    """
    count = len(languages)
    total = evidence.agg(*[F.sum(F.col("shares")[i]).alias(f"s{i}") for i in range(count)]).first()
    total = np.array([x or 0.0 for x in total])
    overall = (total + 1) / (total.sum() + count)
    tables = {}
    for key in ("declared", "suffix"):
        kinds = _sums(evidence, key, languages)
        weights = [F.log((F.col(f"s{i}") + SMOOTHING) / float(total[i] + 1)) for i in range(count)]
        tables[key] = kinds.select(F.col(key), F.array(*weights).alias("weight"))
    hosts = _sums(evidence, "host", languages).withColumn("domain", domain_of(F.col("host")))
    # what all languages of a host or domain share is summed over an array: an expression of so many terms in each of them would be their square
    of_all = lambda name: F.aggregate(F.array(*[f"{name}{i}" for i in range(count)]), F.lit(0.0), lambda a, b: a + b)
    hosts = staged(hosts.withColumn("host_rows", of_all("s")), "hosts")
    domains = staged(hosts.groupBy("domain").agg(*[F.sum(f"s{i}").alias(f"d{i}") for i in range(count)]).withColumn("domain_rows", of_all("d")), "domains")
    above = domains.select("domain", *[((F.col(f"d{i}") + PRIOR_ROWS * float(overall[i])) / (F.col("domain_rows") + PRIOR_ROWS)).alias(f"p{i}") for i in range(count)])
    prior = [F.log((F.col(f"s{i}") + PRIOR_ROWS * F.col(f"p{i}")) / (F.col("host_rows") + PRIOR_ROWS)) for i in range(count)]
    tables["host"] = hosts.join(above, "domain").select("host", F.array(*prior).alias("weight"))
    return tables


def _divisor(triples: Column) -> Column:
    """Never zero: what stands behind a condition is computed on all rows where Spark shares it between expressions."""
    return F.greatest(triples, F.lit(1))


def _per_triple(scores: Column, triples: Column) -> Column:
    return scores / F.least(_divisor(triples), F.lit(EVIDENCE_TRIPLES))


def least_likelihoods(evidence: DataFrame, model: np.ndarray, languages: Sequence[str]) -> tuple[list[float], list[float]]:
    """For each language the least mean log likelihood per triple, and the deviation of one triple."""
    best = (F.array_position("scores", F.array_max("scores")) - 1).cast("int")
    names = F.array(*[F.lit(x) for x in languages])
    rows = evidence.where("triples > 0").select(
        best.alias("at"), _per_triple(F.array_max("scores"), F.col("triples")).alias("mean"),
        (F.get(names, best) == F.col("declared")).alias("agreed"),
    )
    medians = rows.where("agreed").groupBy("at").agg(F.percentile_approx("mean", 0.5).alias("median")).collect()
    uniform = -float(np.log(model.shape[1]))
    least = [uniform] * len(languages)
    for row in medians:
        least[row["at"]] = (row["median"] + uniform) / 2
    shares = np.exp(model)
    variances = (shares * model**2).sum(axis=1) - (shares * model).sum(axis=1) ** 2
    return least, np.sqrt(np.maximum(variances, 0)).tolist()


def domain_of(host: Column) -> Column:
    """The last two labels of a host; the host itself if it has fewer."""
    return F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)


def identified(
    rows: DataFrame, text: str, declared: Column, address: Column, model: np.ndarray,
    languages: Sequence[str], keep: Sequence[str] | None = None,
) -> tuple[DataFrame, str]:
    """The rows (columns ``keep``, or all) with a struct of language, posterior, text_language and kept, and its name.

    Evidence tables are broadcast once their bytes were counted; beyond that the joins shuffle and
    Spark splits skewed keys.
    """
    spark = rows.sparkSession
    name = fresh_name(rows, "evidence")
    held = spark.sparkContext.broadcast(model)
    measured = F.arrow_udf(_text_evidence(held), "struct<triples:bigint,scores:array<double>>")
    host = host_of(address)
    found = F.struct(
        F.col(f"`{name}`.triples").alias("triples"), F.col(f"`{name}`.scores").alias("scores"),
        primary_tag(declared).alias("declared"), host.alias("host"),
        F.when(host.contains("."), F.regexp_extract(host, r"\.([^.]*)$", 1)).alias("suffix"),
    )
    kept_columns = [F.col(f"`{c}`") for c in (rows.columns if keep is None else keep)]
    with text_batches(spark):
        measured_rows = staged(rows.withColumn(name, measured(F.col(f"`{text}`"))).select(*kept_columns, found.alias(name)), "evidence")
    evidence = measured_rows.select(f"`{name}`.*").withColumn("shares", F.when(F.col("triples") > 0, normalised(F.col("scores"))))
    out, weights = measured_rows, []
    for key, table in evidence_tables(evidence.where("triples > 0"), languages).items():
        weight = fresh_name(out, f"{name}_{key}")
        weights.append(weight)
        table = broadcast_if_small(staged(table, key).select(F.col(key).alias(f"{weight}_key"), F.col("weight").alias(weight)))
        out = out.join(table, F.col(f"`{name}`.{key}") == F.col(f"{weight}_key"), "left").drop(f"{weight}_key")
    total = F.transform(
        F.col(f"`{name}`.scores"),
        lambda x, i: x + sum((F.coalesce(F.get(F.col(f"`{w}`"), i), F.lit(0.0)) for w in weights), F.lit(0.0)),
    )
    shares = fresh_name(out, f"{name}_shares")
    out = out.withColumn(shares, normalised(total))
    names = F.array(*[F.lit(x) for x in languages])
    best = lambda scores: F.get(names, F.array_position(scores, F.array_max(scores)).cast("int") - 1)
    posterior = F.array_max(F.col(f"`{shares}`"))
    triples = F.col(f"`{name}`.triples")
    texts = triples > 0
    chosen = F.array_position(F.col(f"`{shares}`"), posterior).cast("int") - 1
    least, deviations = (F.array(*[F.lit(float(x)) for x in values]) for values in least_likelihoods(evidence, model, languages))
    likely = _per_triple(F.get(F.col(f"`{name}`.scores"), chosen), triples) >= F.get(least, chosen) - F.get(deviations, chosen) * ERRORS * F.sqrt(3 / _divisor(triples))
    certain = texts & (posterior >= LEAST_POSTERIOR) & (F.get(names, chosen) != OTHER) & likely
    tag = F.col(f"`{name}`.declared")
    unlearnt = texts & tag.isNotNull() & ~tag.isin(*languages, *NO_LANGUAGES)
    verdict = F.struct(
        F.when(unlearnt & ~certain, tag).otherwise(best(F.col(f"`{shares}`"))).alias("language"), posterior.alias("posterior"),
        F.when(texts, best(F.col(f"`{name}`.scores"))).alias("text_language"),
        F.coalesce(certain | unlearnt, F.lit(False)).alias("kept"),
    )
    return out.withColumn(name, verdict).drop(shares, *weights), name


def document_languages(docs: DataFrame, keep: Sequence[str] | None = None) -> tuple[DataFrame, str]:
    """Documents: ``lang`` is what they declare, ``source`` their address; the model learns from all of them."""
    tag = primary_tag(F.col("lang"))
    languages = languages_of(docs, "text", tag)
    return identified(docs, "text", F.col("lang"), F.col("source"), train(docs, "text", tag, languages), languages, keep=keep)


def page_languages(pages: DataFrame, keep: Sequence[str] | None = None) -> tuple[DataFrame, str]:
    """Pages: their markup declares a language, ``url`` is the address, and the text is the extracted one."""
    declared, text = fresh_name(pages, "declared"), fresh_name(pages, "main_text")
    rows, text = extracted(pages.withColumn(declared, markup_language(F.col("html"))), name=text)
    # read three times
    rows = staged(rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "html" or keep is None or "html" in keep]), "pages")
    tag = primary_tag(F.col(f"`{declared}`"))
    languages = languages_of(rows, text, tag)
    keep = [*(pages.columns if keep is None else keep), declared]
    return identified(rows, text, F.col(f"`{declared}`"), F.col("url"), train(rows, text, tag, languages), languages, keep=keep)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows that are not rejected, with their columns."""
    rows, verdict = document_languages(docs)
    return rows.where(F.col(f"`{verdict}`.kept")).select(*[F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows, verdict = document_languages(spark.read.parquet(f"{folder}/documents.parquet"), keep=["doc_id", "lang"])
    return rows.select("doc_id", F.col("lang").alias("declared"), f"`{verdict}`.*")


def pages_query(spark: SparkSession, folder: str) -> DataFrame:
    rows, verdict = page_languages(spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url", "html"), keep=["page_id", "url"])
    return rows.select("page_id", "url", "declared", f"`{verdict}`.*")
