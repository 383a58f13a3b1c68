"""Exact top-k search in Hamming space by multi-index hashing.

A vector's code is the signs of all its centred dimensions, in words of ``BITS``. Codes are cut into segments of about log2(rows)
bits, and each segment is an index key. A query looks up, segment by segment, all keys within radius
0, then 1, 2, ... of its own; every code met is verified by its full distance. After radius r in all m
segments each code at a distance below m * (r + 1) has been met (else every segment would differ in more
than r bits), so a query is done once its k-th verified distance is below that; only the others go on. Since a
radius has many keys, lookups are cheaper than a scan only while they are fewer than the segment's
keys in use; from then on the segments' own lists of keys in use are joined by distance instead.

Rows with the same code are one index entry, with its count and its k smallest ids, so a vector that
occurs often is no hot key, and the result is as if all rows had been compared: per query the k rows
nearest in Hamming distance, ties by smallest id, without the query's own row.

Defined results: rows without id or vector, and vectors of another length than most (of two that are as
frequent, the larger counts), are neither queries nor found; a NULL or NaN dimension counts as not above the mean; ids that repeat count as one row,
with the smallest code; with fewer than k other rows all of them are found. Further columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.staging import staged
from millrace.operators.joins import BROADCAST_BYTES

# Bits of a code's word. The SQL below is for vectors of so many dimensions.
BITS = 64
K = 10
QUERY_STEP = 20
LEAST_SEGMENT, MOST_SEGMENT = 8, 20
INDEX_BYTES = 64


def codes(vectors: DataFrame) -> DataFrame:
    """vec_id and code: bit i is set where dimension i lies above its mean over all rows.

    The code is one bigint, or an array of them if the vectors have more than ``BITS`` dimensions; the
    column's metadata have the number of its bits.
    """
    known = vectors.where("vec_id is not null and embedding is not null")
    sizes = known.groupBy(F.size("embedding").alias("size")).count()
    prevailing = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = prevailing["size"] if prevailing else 0
    known = known.where(F.size("embedding") == size)
    values = known.select(F.posexplode("embedding").alias("at", "x")).where(~F.isnan("x"))
    means = {r["at"]: r["mean"] for r in values.groupBy("at").agg(F.avg("x").alias("mean")).collect()}
    words = []
    for low in range(0, max(size, 1), BITS):
        here = range(low, max(min(low + BITS, size), low + 1))
        limits = f"array({', '.join(f'{means.get(i, 0.0)!r}D' for i in here)})"
        value = f"get(embedding, i + {low})"
        above = f"coalesce({value} > get({limits}, i) AND NOT isnan({value}), false)"
        words.append(F.expr(f"aggregate(sequence(0, {len(here) - 1}), 0L, (bits, i) -> bits | if({above}, shiftleft(1L, i), 0L))"))
    code = F.array(*words) if len(words) > 1 else words[0]
    coded = known.select(F.col("vec_id").cast("bigint").alias("vec_id"), code.alias("code"))
    return coded.groupBy("vec_id").agg(F.min("code").alias("code", metadata={"bits": max(size, 1)}))


def _words(code: Column, bits: int) -> list[Column]:
    return [F.get(code, F.lit(i)) for i in range(-(-bits // BITS))] if bits > BITS else [code]


def segment_bits(rows: int, bits: int = BITS) -> int:
    """Bits of a segment: so many that a key has about one row, were codes spread evenly."""
    wanted = min(max(rows.bit_length() - 1, LEAST_SEGMENT), MOST_SEGMENT)
    segments = -(-bits // wanted)
    return -(-bits // segments)


def _keys(code: Column, width: int, bits: int = BITS) -> Column:
    """(segment, key) of all segments of a code."""
    parts, words = [], _words(code, bits)
    for i, low in enumerate(range(0, bits, width)):
        mask = (1 << min(width, bits - low)) - 1
        word, shift = divmod(low, BITS)
        key = F.shiftrightunsigned(words[word], shift)
        if shift + mask.bit_length() > BITS:  # the segment goes on in the next word
            key = key.bitwiseOR(F.shiftleft(words[word + 1], BITS - shift))
        parts.append(F.struct(F.lit(i).alias("segment"), key.bitwiseAND(F.lit(mask)).cast("int").alias("key")))
    return F.array(*parts)


def _distance(x: str, y: str, bits: int = BITS) -> Column:
    pairs = zip(_words(F.col(x), bits), _words(F.col(y), bits), strict=True)
    return sum((F.bit_count(a.bitwiseXOR(b)) for a, b in pairs), F.lit(0)).cast("int")


def _masks(spark: SparkSession, width: int, radius: int) -> Column:
    """All keys' differences of ``radius`` bits, as a constant array of fixed size."""
    from itertools import combinations

    values = [sum(1 << b for b in chosen) for chosen in combinations(range(width), radius)]
    return F.from_json(F.lit(str(values)), "array<int>")


def nearest(rows: DataFrame, queries: DataFrame, k: int = K, bits: int | None = None) -> DataFrame:
    """query_id, neighbor_id, distance and rank: the k rows of (vec_id, code) nearest to each of the queries.

    Both are read several times: stage them. ``bits`` are those of a code, if its column does not say.
    """
    spark = rows.sparkSession
    bits = bits or rows.schema["code"].metadata.get("bits", BITS)
    order = Window.partitionBy("code").orderBy("vec_id")
    # one more id than asked for, as a query does not count itself
    firsts = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    entries = staged(firsts.groupBy("code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "entries")
    width = segment_bits(rows.count(), bits)
    segments = -(-bits // width)
    index = staged(entries.select("code", F.explode(_keys(F.col("code"), width, bits)).alias("at")).select("at.segment", "at.key", "code"), "index")
    # The lookups are exploded rows, whose size Spark underestimates: it may broadcast the index if that was
    # counted to be small, but never the lookups.
    few = index.count() * (INDEX_BYTES + (bits - 1) // BITS * 16) <= BROADCAST_BYTES
    looked_up = F.broadcast(index) if few else index.hint("merge")
    used_keys = staged(index.select("segment", "key").distinct(), "keys")
    key_count = used_keys.count()
    # queries with the same code have the same entries near them
    asked = staged(queries.select(F.col("vec_id").alias("query_id"), F.col("code").alias("asked")), "asked")
    open_codes = asked.select("asked", F.lit(bits).alias("bound")).distinct()
    sizes = entries.select("code", F.size("ids").alias("size"))
    done, found = None, None
    for radius in range(width + 1):
        probes = open_codes.select("asked", "bound", F.explode(_keys(F.col("asked"), width, bits)).alias("at")).select("asked", "bound", "at.segment", F.col("at.key").alias("own"))
        masks = 1
        for i in range(radius):
            masks = masks * (width - i) // (i + 1)
        if masks * segments <= max(key_count, 1):
            near = probes.withColumn("mask", F.explode(_masks(spark, width, radius))).select("asked", "bound", "segment", F.col("own").bitwiseXOR(F.col("mask")).alias("key"))
        else:
            near = probes.join(used_keys, "segment").where(F.bit_count(F.col("own").bitwiseXOR(F.col("key"))) == radius).select("asked", "bound", "segment", "key")
        # verified where they meet: nothing beyond the k-th distance so far leaves the join
        pairs = near.join(looked_up, ["segment", "key"]).where(_distance("asked", "code", bits) <= F.col("bound"))
        met = pairs.select("asked", "code").distinct()
        if found is not None:
            met = met.unionByName(found.select("asked", "code")).distinct()
        ranked = met.withColumn("distance", _distance("asked", "code", bits)).join(sizes, "code")
        ahead = Window.partitionBy("asked").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        # an entry is needed while fewer than k + 1 rows lie nearer
        found = staged(
            ranked.withColumn("nearer", F.coalesce(F.sum("size").over(ahead), F.lit(0))).where(F.col("nearer") <= k), "found"
        )
        reached = found.groupBy("asked").agg(F.sum("size").alias("rows"), F.max("distance").alias("furthest"))
        # all codes nearer than this have been met
        covered = segments * (radius + 1)
        complete = (F.col("rows") > k) & (F.col("furthest") < covered)
        over = reached.where(complete).select("asked") if radius < width else open_codes.select("asked")
        ready = staged(found.join(over, "asked", "left_semi"), "ready")
        done = ready if done is None else done.unionByName(ready)
        bound = F.when(F.col("rows") > k, F.col("furthest")).otherwise(F.lit(bits)).alias("bound")
        still = open_codes.select("asked").join(over, "asked", "left_anti").join(reached, "asked", "left")
        open_codes = staged(still.select("asked", bound), "open")
        if open_codes.isEmpty():
            break
        found = found.join(open_codes.select("asked"), "asked", "left_semi")
    ids = done.select("asked", "code", "distance").join(entries, "code").select("asked", "distance", F.explode("ids").alias("neighbor_id"))
    pairs = asked.join(ids, "asked").where("neighbor_id <> query_id")
    best = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "neighbor_id", "distance", "rank")


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = codes(spark.read.parquet(f"{folder}/embeddings.parquet"))
    rows = staged(rows, "vectors")
    return nearest(rows, rows.where(F.col("vec_id") % QUERY_STEP == 0))


SQL = f"""
WITH known AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
dims AS (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM known),
means AS (SELECT i, avg(x::DOUBLE) AS m FROM dims GROUP BY i),
signs AS (SELECT vec_id, i, CASE WHEN x > m THEN 1 ELSE 0 END AS one FROM dims JOIN means USING (i) WHERE i < {BITS}),
codes AS (SELECT vec_id, string_agg(one::VARCHAR, '' ORDER BY i)::BIT AS code FROM signs GROUP BY vec_id),
pairs AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, bit_count(xor(q.code, r.code))::INTEGER AS distance
          FROM codes q JOIN codes r ON q.vec_id <> r.vec_id WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, neighbor_id, distance, rank::INTEGER AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS rank FROM pairs)
WHERE rank <= {K}
"""
