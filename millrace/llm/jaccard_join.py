"""N-gram Jaccard join: all documents whose shingle sets are alike, as groups.

A document's set holds the hashes of its runs of ``WIDTH`` words (lower-cased A-Z). Two sets link when
``100 * intersection >= 80 * union``; a group is what links reach. The join is exact:

1. Equal sets fall together (a hash of the set is its *node*), so copies are never paired.
2. Every set is ordered, rare shingles first; two sets that link share one of the first fifth of
   either. These *postings* are the index lists. Shingles seen often come last in the order, so that
   passages common to many documents do not make long lists. (Frequent ones are found by counting
   every run of ``RUN_SHINGLES`` shingles; which of them are in the table changes the work only.)
3. Each node of a list meets the list's leader and its predecessor by size. A pair is dropped if
   the places where it meets, or the parity bitmaps of its sets, prove that it has too little in
   common (:func:`_may_link`); the rest are compared set against set, each node with one partner.
   Nodes found to be alike become one component.
4. Lists whose nodes are all in one component are done. In the others, nodes outside the list's largest
   component are compared with a few members of that one, some rounds long (:func:`_hub_pairs`).
   What is apart then meets, node by node, by size blocks: a posting's position says how large a partner may still be, so whole blocks
   of a list are skipped (:func:`_reachable_blocks`), and a pair whose bitmaps differ in too many bits
   is dropped where it meets.
5. Such a pair's overlap is first bounded from a highly similar set's: if x is close to h and the
   overlap of h and y is known, that of x and y differs by at most what x and h do not share
   (:func:`_derived`). Only pairs left open by the bounds are compared set against set.

What crosses the network per document is a fifth of its set, its bitmap (a quarter to half a byte per
shingle, also with each posting of a long open list), and the sets of documents that are in a pair the bounds leave.
Copies fall together, and near copies are compared with leaders until they are one component. Texts that are
nearly alike but link with nothing stay apart: within such a family each pair has its bitmaps compared where it
meets in a long list, so that work does grow with the square of the family; few of the pairs leave the join.

Defined results: a document with fewer words than ``WIDTH`` has its whole sequence as only element;
without words, or with a NULL text, its set is empty and it links with nothing. Rows that repeat a
doc_id each get a result row; a NULL doc_id never names a group that has another id. Hashes have 64
bits and are taken as the values they stand for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.components import contracted, relabelled
from millrace.llm.staging import broadcast_if_few, fresh_name, small_batches, staged
from millrace.llm.wordhash import mixed, pieces, windows, words

WIDTH = 5
# What counts as frequent, and how many frequent shingles the order knows.
RUN_SHINGLES = 2_000_000
RUN_HITS = 4
FREQUENT = 200_000
# A frequent shingle's list is dealt to parts of about so many postings for the comparison with leaders.
PART_POSTINGS = 5_000
# Bits of the map of documents whose sets are needed: 8 MB; more of them only make it pass more.
MAP_BITS = 1 << 26
# Bits of the parity bitmap of the smallest sets.
LEAST_BITS = 64
BLOCK_RATIO = 1.06
# In lists of so many nodes their bitmaps are compared where they meet, as they are then lighter than the pairs;
# pairs of shorter lists are tested later. Blocks are wider there, so that a bitmap travels to few of them.
LARGE_LIST = 16
LARGE_RATIO = 1.25
# Rounds of comparisons with members of a list's largest component, and how many of them.
HUB_ROUNDS = 1
HUBS = 3
PAIR_BYTES = 96
KEY_BYTES = 128
# Partners of a node that are looked at first; the later steps find what they miss.
PARTNERS = 6


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for piece in pieces(texts):
        hashes, firsts = words(piece, lower=True)
        runs = windows(hashes, width)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if b - a >= width:
                found = np.sort(runs[a : b - width + 1])
                if len(found) > 1:
                    found = found[np.concatenate(([True], found[1:] != found[:-1]))]
                yield found
            elif b > a:
                yield windows(hashes[a:b], b - a)
            else:
                yield np.empty(0, np.uint64)


def node_of(found: np.ndarray) -> int | None:
    """The set's hash, the same for equal sets; None for the empty set."""
    if not len(found):
        return None
    return int(mixed(np.array([mixed(found).sum(dtype=np.uint64) + np.uint64(len(found))]))[0].astype(np.int64))


def parity_bitmap(found: np.ndarray) -> np.ndarray:
    """Bits, in words of 64, that each element flips one of; two to four for an element, a power of two.

    Two sets differ in at least as many elements as bits, also after the longer bitmap was folded.
    """
    bits = max(LEAST_BITS, 2 << (len(found) - 1).bit_length()) if len(found) else LEAST_BITS
    flips = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def _flipped(left: pa.Array, right: pa.Array) -> pa.Array:
    """In how many bits the bitmaps differ."""
    out = np.zeros(len(left), np.int32)
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        x, y = x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64)
        if len(x) > len(y):
            x, y = y, x
        if len(x) < len(y):
            y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
        out[i] = int(np.bitwise_count(x ^ y).sum())
    return pa.array(out)


def _counted(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that the sets have ``RUN_HITS`` times or more, and how often. Empties the list."""
    held = np.concatenate(runs) if runs else np.empty(0, np.uint64)
    runs.clear()
    held.sort()
    values = np.unique(held[: 1 - RUN_HITS][held[RUN_HITS - 1 :] == held[: 1 - RUN_HITS]])
    hits = np.searchsorted(held, values, "right") - np.searchsorted(held, values, "left")
    return values.astype(np.int64), hits


_SURVEY = pa.schema([
    ("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int32()), ("node", pa.int64()), ("bitmap", pa.list_(pa.int64())), ("token", pa.int64()), ("hits", pa.int64()),
])
_SURVEY_DDL = "doc_id bigint, digest binary, n int, node bigint, bitmap array<bigint>, token bigint, hits bigint"


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document with its digest, and one for each shingle that a run of them has often."""
    runs, size = [], 0

    def frequent():
        values, hits = _counted(runs)
        empty = pa.nulls(len(values))
        return pa.RecordBatch.from_arrays(
            [*[empty.cast(_SURVEY.field(i).type) for i in range(5)], pa.array(values), pa.array(hits)], schema=_SURVEY
        )

    for batch in batches:
        lengths, nodes, bitmaps = [], [], []
        for found in shingle_sets(batch.column(1)):
            lengths.append(len(found))
            nodes.append(node_of(found))
            bitmaps.append(parity_bitmap(found))
            runs.append(found)
            size += len(found)
            if size >= RUN_SHINGLES:
                yield frequent()
                size = 0
        empty = pa.nulls(len(batch), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(lengths, pa.int32()), pa.array(nodes, pa.int64()), pa.array(bitmaps, pa.list_(pa.int64())), empty, empty],
            schema=_SURVEY,
        )
    yield frequent()


def prefix_length(n: int) -> int:
    """How many of a set's first elements meet those of any set it links with."""
    return n - (4 * n + 4) // 5 + 1


def _fresh_sets(batches, seen: set) -> Iterator[tuple[int, np.ndarray]]:
    """Node and set of documents, each node once a task."""
    for batch in batches:
        for found in shingle_sets(batch.column(1)):
            node = node_of(found)
            if node is not None and node not in seen:
                seen.add(node)
                yield node, found


def _postings(frequent):
    """A task that gives each set's first elements in the order that all sets share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, hits = frequent.value
        out, size = [], 0

        def flush():
            nodes, n, tokens, part = zip(*out, strict=True)
            counts = [len(t) for t in tokens]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(tokens).astype(np.int64)),
                    pa.array(np.repeat(np.array(nodes, np.int64), counts)),
                    pa.array(np.repeat(np.array(n, np.int32), counts)),
                    pa.array(np.concatenate([np.arange(c, dtype=np.int32) for c in counts])),
                    pa.array(np.concatenate(part)),
                ],
                names=["token", "node", "n", "pos", "part"],
            )

        for node, found in _fresh_sets(batches, set()):
            at = np.searchsorted(values, found)
            known = np.zeros(len(found), np.int64)
            inside = at < len(values)
            inside[inside] = values[at[inside]] == found[inside]
            known[inside] = hits[at[inside]]
            order = np.argsort(known, kind="stable")[: prefix_length(len(found))]
            spread = 1 + known[order] // PART_POSTINGS
            # a part above 0 tells that the list has several
            part = np.where(spread > 1, 1 + np.uint64(node & 0x7FFFFFFFFFFFFFFF) % spread.astype(np.uint64), 0).astype(np.int32)
            out.append((node, len(found), found[order], part))
            size += len(order)
            if size >= 200_000:
                yield flush()
                out, size = [], 0
        if out:
            yield flush()

    return run


def _chosen_sets(needed):
    """A task that gives the sets of the documents that the map has; other texts are not looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            bit = np.mod(batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False), MAP_BITS)
            wanted = needed.value[bit >> 3] >> (bit & 7).astype(np.uint8) & 1
            chosen = batch.filter(pa.array(wanted.astype(bool)))
            # few texts at a time, so that their sets are no burden
            for at in range(0, len(chosen), 500):
                out = list(_fresh_sets([chosen.slice(at, 500)], seen))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1].tobytes() for x in out], pa.binary())],
                        names=["node", "elements"],
                    )

    return run


def _document_map(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``MAP_BITS`` bits in which the documents' bits are set; NULL has the bit of -1."""
    bit = F.pmod(F.coalesce("doc_id", F.lit(-1)), F.lit(MAP_BITS)) + 1
    rows = (
        ids.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
        .collect()
    )
    out = np.zeros(MAP_BITS >> 3, np.uint8)
    for row in rows:
        bits = np.frombuffer(bytes(row.bits), np.uint8)
        at = (row.bucket - 1) * 4096
        out[at : at + len(bits)] = bits[: len(out) - at]
    return out


def _pair(x: str, y: str, nx: str, ny: str) -> list[Column]:
    swap = F.col(x) > F.col(y)
    return [
        F.when(swap, F.col(y)).otherwise(F.col(x)).alias("a"), F.when(swap, F.col(x)).otherwise(F.col(y)).alias("b"),
        F.when(swap, F.col(ny)).otherwise(F.col(nx)).alias("na"), F.when(swap, F.col(nx)).otherwise(F.col(ny)).alias("nb"),
    ]


def _sizes_fit(x: str, y: str) -> Column:
    return (5 * F.least(x, y)) >= (4 * F.greatest(x, y))


def _enough(overlap: Column) -> Column:
    """100 * intersection >= 80 * union, with the union as na + nb - intersection."""
    return 9 * overlap >= 4 * (F.col("na") + F.col("nb"))


def _places_fit(n: str, pos: str, m: str, at: str) -> Column:
    """Whether sets of sizes n and m that first meet at these places can still link.

    All they share lies there or behind, and 9 * overlap >= 4 * (n + m) is due.
    """
    need = 4 * (F.col(n) + F.col(m))
    return (9 * (F.col(n) - F.col(pos)) >= need) & (9 * (F.col(m) - F.col(at)) >= need)


def _leader_pairs(postings: DataFrame) -> DataFrame:
    """Each posting's node with the list's leader and with the one before it."""
    met = postings.withColumn("other", F.explode(F.array("leader", "before"))).where("other is not null and other.node <> node")
    met = met.select("node", "n", "pos", F.col("other.node").alias("partner"), F.col("other.n").alias("m"), F.col("other.pos").alias("at"))
    fit = met.where(_sizes_fit("n", "m") & _places_fit("n", "pos", "m", "at"))
    return fit.select(*_pair("node", "partner", "n", "m")).distinct()


def _may_link(pairs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The staged pairs whose bitmaps do not differ in more bits than linked sets differ in elements."""
    flipped = F.arrow_udf(_flipped, "int")
    one = bitmaps.select(F.col("node").alias("a"), F.col("bitmap").alias("left"))
    two = bitmaps.select(F.col("node").alias("b"), F.col("bitmap").alias("right"))
    both = one.join(broadcast_if_few(pairs, PAIR_BYTES), "a").join(two, "b")
    return both.where(9 * flipped("left", "right") <= F.col("na") + F.col("nb")).select("a", "b", "na", "nb")


def _few_partners(pairs: DataFrame, most: int) -> DataFrame:
    """For each node the pairs with its smallest partners: alike nodes mostly choose the same ones."""
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("partner"), "a", "b", "na", "nb").unionByName(
        pairs.select(F.col("b").alias("node"), F.col("a").alias("partner"), "a", "b", "na", "nb")
    )
    order = Window.partitionBy("node").orderBy("partner")
    return ends.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).select("a", "b", "na", "nb").distinct()


def _common(left: pa.Array, right: pa.Array) -> pa.Array:
    out = np.zeros(len(left), np.int32)
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
        if len(x) > len(y):
            x, y = y, x
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        out[i] = np.count_nonzero(y[at] == x)
    return pa.array(out)


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The staged pairs with the sizes of their intersections, set against set."""
    common = F.arrow_udf(_common, "int")
    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("elements").alias("right"))
    both = one.join(broadcast_if_few(pairs, PAIR_BYTES), "a").join(two, "b")
    found = both.select("a", "b", "na", "nb", common("left", "right").alias("overlap")).dropDuplicates(["a", "b"])
    with small_batches(pairs.sparkSession):
        return staged(found, "compared")


def _known(compared: DataFrame) -> DataFrame:
    return broadcast_if_few(compared.select("a", "b"), PAIR_BYTES)


def _linked(compared: DataFrame) -> DataFrame:
    return compared.where(_enough(F.col("overlap"))).select("a", "b")


def _open_lists(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings of lists that still have nodes of several components, with their labels and the list's length."""
    known = relabelled(shared.withColumn("label", F.col("node")), labels, "label")
    mixed_lists = known.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("length")).where("low <> high")
    return staged(known.join(mixed_lists.select("token", "length"), "token"), "lists")


def _hub_pairs(lists: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Nodes outside the largest component of a list, with a few of that component's nodes there."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    sized = lists.join(sizes, "label", "left").withColumn("rank", F.struct(F.coalesce("size", F.lit(1)).alias("size"), "label"))
    whole = Window.partitionBy("token")
    largest = sized.withColumn("largest", F.max("rank").over(whole)).withColumn("outside", F.col("label") != F.col("largest.label"))
    order = Window.partitionBy("token", "outside").orderBy(F.xxhash64("node", F.lit(turn)))
    ranked = largest.withColumn("place", F.when(~F.col("outside"), F.row_number().over(order)))
    hubs = F.collect_list(F.when(F.col("place") <= HUBS, F.struct(F.col("node").alias("hub"), F.col("n").alias("m")))).over(whole)
    met = ranked.withColumn("hubs", hubs).where("outside").select("node", "n", F.explode("hubs").alias("one")).select("node", "n", "one.*")
    return met.where(_sizes_fit("n", "m")).select(*_pair("node", "hub", "n", "m")).distinct()


def _block(size: Column) -> Column:
    ratio = F.when(F.col("length") >= LARGE_LIST, LARGE_RATIO).otherwise(BLOCK_RATIO)
    return F.floor(F.log(size) / F.log(ratio)).cast("int")


def _reachable_blocks(n: str, pos: str) -> Column:
    """Size blocks of the partners no larger than a set of ``n`` that may first meet it at ``pos``.

    All that two sets share lies at or behind the first place where they meet, so a partner of size m
    needs 9 * (n - pos) >= 4 * (n + m) and 5 * m >= 4 * n.
    """
    least = F.ceil(F.col(n) * 4 / 5)
    most = F.least(F.col(n), F.floor((9 * (F.col(n) - F.col(pos)) - 4 * F.col(n)) / 4))
    return F.when(most >= least, F.sequence(_block(least), _block(most)))


def _bits_fit() -> Column:
    """Whether the bitmaps of two sets allow a link; those missing or of unlike lengths are left to :func:`_may_link`."""
    apart = F.zip_with("bits", "bits_y", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.col("bits").isNull() | (F.size("bits") != F.size("bits_y")) | (9 * F.aggregate(apart, F.lit(0), lambda total, x: total + x) <= F.col("n") + F.col("m"))


def _block_pairs(lists: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Pairs of different components that meet in a list at places, with sizes and bitmaps that allow a link."""
    large = F.col("length") >= LARGE_LIST
    lists = lists.where(large).join(bitmaps.withColumnRenamed("bitmap", "bits"), "node").unionByName(
        lists.where(~large).withColumn("bits", F.lit(None).cast("array<bigint>"))
    )
    index = lists.select(
        "token", _block(F.col("n")).alias("block"), F.col("node").alias("y"), F.col("n").alias("m"), F.col("pos").alias("at"),
        F.col("label").alias("other"), F.col("bits").alias("bits_y"),
    )
    probe = lists.select("token", F.explode(_reachable_blocks("n", "pos")).alias("block"), "node", "n", "pos", "label", "bits")
    return (
        probe.join(index, ["token", "block"])
        .where("other <> label and (m < n or (m = n and y < node)) and 5 * m >= 4 * n")
        .where(_places_fit("n", "pos", "m", "at"))
        .where(_bits_fit())
        .select(*_pair("node", "y", "n", "m"))
        .distinct()
    )


def _derived(pairs: DataFrame, compared: DataFrame) -> DataFrame:
    """The pairs with bounds of their overlap, from those of sets that are much like one side.

    For x close to h: overlap(x, y) is at most overlap(h, y) + what x has beyond h, and at least
    overlap(h, y) less what h has beyond x.
    """
    both = compared.select(F.col("a").alias("x"), F.col("b").alias("h"), F.col("na").alias("nx"), F.col("nb").alias("nh"), "overlap").unionByName(
        compared.select(F.col("b").alias("x"), F.col("a").alias("h"), F.col("nb").alias("nx"), F.col("na").alias("nh"), "overlap")
    )
    nearest = both.groupBy("x").agg(F.max_by(F.struct("h", "nx", "nh", "overlap"), F.struct(F.col("overlap") / (F.col("nx") + F.col("nh") - F.col("overlap")), "h")).alias("near"))
    nearest = nearest.select("x", "near.h", (F.col("near.nx") - F.col("near.overlap")).alias("more"), (F.col("near.nh") - F.col("near.overlap")).alias("less"))
    known = both.select(F.col("x").alias("kx"), F.col("h").alias("kh"), F.col("overlap").alias("known"))
    known = broadcast_if_few(known, PAIR_BYTES)
    nearest = broadcast_if_few(staged(nearest, "nearest"), PAIR_BYTES)
    out = pairs.withColumn("most", F.least("na", "nb")).withColumn("least", F.lit(0))
    for x, y in (("a", "b"), ("b", "a")):
        near = nearest.select(F.col("x").alias("_x"), F.col("h").alias("_h"), F.col("more").alias("_more"), F.col("less").alias("_less"))
        out = out.join(near, F.col(x) == F.col("_x"), "left")
        out = out.join(known, (F.col("_h") == F.col("kx")) & (F.col(y) == F.col("kh")), "left")
        out = out.withColumn("most", F.least("most", F.col("known") + F.col("_more"))).withColumn("least", F.greatest("least", F.col("known") - F.col("_less")))
        out = out.drop("_x", "_h", "_more", "_less", "kx", "kh", "known")
    return out


def _sets_of(pairs: DataFrame, texts: DataFrame, first_ids: DataFrame) -> DataFrame:
    """The sets of all nodes of the pairs, each from the documents that bear the node's smallest id."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    needed = texts.sparkSession.sparkContext.broadcast(_document_map(first_ids.join(nodes, "node", "left_semi")))
    return staged(texts.mapInArrow(_chosen_sets(needed), "node bigint, elements binary"), "sets")


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach) of every row of (doc_id, text)."""
    rows, named = _grouped(docs)
    return rows.join(named.select("node", "component_id"), "node", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def _grouped(docs: DataFrame, digest: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """A row (doc_id, n, node, digest) of every document, and for every node its component (label) and that
    one's smallest doc_id."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    digest = F.lit(None).cast("binary") if digest is None else digest
    survey = staged(texts.select("doc_id", "text", digest.alias("digest")).mapInArrow(_survey, _SURVEY_DDL), "shingles")
    rows = survey.where("n is not null").select("doc_id", "n", "node", "bitmap", "digest")
    classes = staged(
        rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bitmap").alias("bitmap")), "nodes"
    )
    first_ids, bitmaps = classes.select("node", "doc_id"), classes.select("node", "bitmap")

    often = survey.where("token is not null").groupBy("token").agg(F.sum("hits").alias("hits"))
    table = often.orderBy(F.desc("hits"), "token").limit(FREQUENT).toPandas()
    values = table["token"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(values)
    frequent = spark.sparkContext.broadcast((values[order], table["hits"].to_numpy(np.int64)[order]))

    postings = texts.mapInArrow(_postings(frequent), "token bigint, node bigint, n int, pos int, part int")
    member = Window.partitionBy("token", "part").orderBy("n", "node")
    ranked = postings.select(
        "token", "node", "n", "pos", "part",
        F.first(F.struct("node", "n", "pos")).over(member).alias("leader"),
        F.lag(F.struct("node", "n", "pos")).over(member).alias("before"),
        F.last("node").over(member.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("end"),
    )
    ranked = staged(ranked.where("part > 0 or leader.node <> end").drop("end"), "postings")

    pairs = staged(_few_partners(_leader_pairs(ranked), PARTNERS), "pairs")
    pairs = staged(_few_partners(_may_link(pairs, bitmaps), 1), "pairs")
    compared = _compared(pairs, _sets_of(pairs, texts, first_ids))
    labels = contracted(_linked(compared))
    lists = ranked.select("token", "node", "n", "pos").distinct()
    for turn in range(HUB_ROUNDS):
        lists = _open_lists(lists, labels)
        pairs = staged(_hub_pairs(lists, labels, turn).join(_known(compared), ["a", "b"], "left_anti"), "pairs")
        pairs = staged(_may_link(pairs, bitmaps), "pairs")
        fresh = _compared(pairs, _sets_of(pairs, texts, first_ids))
        compared, labels = compared.unionByName(fresh), contracted(_linked(fresh), labels)
        lists = lists.drop("label", "length")

    lists = _open_lists(lists, labels)
    pairs = staged(_block_pairs(lists, bitmaps).join(_known(compared), ["a", "b"], "left_anti"), "pairs")
    pairs = staged(_may_link(pairs, bitmaps), "pairs")
    bounded = staged(_derived(pairs, compared), "bounds")
    links = bounded.where(_enough(F.col("least"))).select("a", "b")
    left_open = bounded.where(~_enough(F.col("least")) & _enough(F.col("most"))).select("a", "b", "na", "nb")
    left_open = staged(left_open, "open")
    if not left_open.isEmpty():
        links = links.unionByName(_linked(_compared(left_open, _sets_of(left_open, texts, first_ids))))
    labels = contracted(links, labels)

    smallest = relabelled(first_ids.withColumn("label", F.col("node")), labels, "label")
    names = smallest.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return rows.select("doc_id", "n", "node", "digest"), smallest.select("node", "label").join(names, "label")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies; all rows without words stay.

    Rows are judged by their texts: of a group that row stays whose doc_id is smallest (NULL last), of several
    such rows that with the smallest text. So rows with one doc_id but texts that are no copies all stay,
    and copies go whether they have an id or not.
    """
    # What names a row: its id and its whole text; equal rows are one row that came twice.
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    rows, components = _grouped(docs, digest)
    keys = rows.where("node is not null").select(F.col("doc_id").alias("id"), "digest", "node")
    rank = F.struct(F.col("id").isNull().alias("no_id"), "id", "digest")
    first = keys.groupBy("node").agg(F.min(rank).alias("rank"))
    best = first.join(components.select("node", "label"), "node").groupBy("label").agg(F.min("rank").alias("rank"))
    best = staged(best.select(F.col("rank.id").alias("best_id"), F.col("rank.digest").alias("best_digest")), "stays")
    counted = keys.groupBy("id", "digest").agg(F.count("*").alias("rows"))
    same = (F.col("digest") == F.col("best_digest")) & F.col("id").eqNullSafe(F.col("best_id"))
    judged = counted.join(best.withColumn("stays", F.lit(True)), same, "left")
    judged = staged(judged.where("stays is null or rows > 1").select("id", "digest", "stays"), "judged")

    name = fresh_name(docs, "row_digest")
    rows, columns = docs.withColumn(name, digest), [F.col(f"`{c}`") for c in docs.columns]
    here = (F.col(f"`{name}`") == F.col("known_digest")) & F.col("doc_id").eqNullSafe(F.col("known_id"))
    known = lambda part: broadcast_if_few(part.select(F.col("id").alias("known_id"), F.col("digest").alias("known_digest")), KEY_BYTES)
    once = rows.join(known(judged), here, "left_anti")
    repeated = rows.join(known(judged.where("stays")), here, "left_semi").dropDuplicates([name, "doc_id"])
    return once.select(*columns).unionByName(repeated.select(*columns))


def query(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(spark.read.parquet(f"{folder}/documents.parquet"))
