"""Operators that relate rows to each other, against brute force."""

import itertools
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import chat_trees, components, hamming_search, jaccard_join, mixing, packing

FOLDER = "/root/testdata/sf0.001"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups_by_brute_force(rows):
    """(doc_id, shingles, component) of every row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    holders = defaultdict(list)
    for i, found in enumerate(sets):
        met = Counter(j for s in found for j in holders[s])
        for j, common in met.items():
            if 100 * common >= 80 * (len(found) + len(sets[j]) - common):
                parent[find(i)] = find(j)
        for s in found:
            holders[s].append(i)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return sorted(((d, len(sets[i]), smallest[find(i)]) for i, (d, _) in enumerate(rows)), key=repr)


def groups_found(docs):
    return sorted((tuple(r) for r in jaccard_join.near_groups(docs).select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def varied(rng, base, changes):
    words = base.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_groups_of_given_documents(spark, make_docs):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert groups_found(docs) == groups_by_brute_force(rows)


def test_groups_of_near_copies_chains_and_shared_passages(spark, make_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "PART_POSTINGS", 5)  # long lists in parts
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(5000)}"
    text = lambda n: " ".join(word() for _ in range(n))
    rows, ids = [], itertools.count(1000)
    bases = [text(200) for _ in range(4)]
    for base in bases:
        rows += [(next(ids), varied(rng, base, rng.choice([0, 1, 2, 4, 5, 6, 8]))) for _ in range(40)]
    chain = text(150).split()
    for i in range(30):  # each links with its neighbours only
        chain[i * 5] = f"c{i}"
        rows.append((next(ids), " ".join(chain)))
    passage = text(60)
    rows += [(next(ids), f"{passage} {text(n)}") for n in (0, 3, 5, 8, 12, 16, 20, 30, 100) for _ in range(12)]
    rows += [(next(ids), t) for t in (None, "", " \n", "one two", "One  two", "a b c d", "a b c d e", "A B c d e", "x " * 400, "x " * 300)]
    rows += [(3, bases[0]), (3, bases[0]), (None, bases[1]), (None, None), (None, "only here among the rows without id")]
    rng.shuffle(rows)
    assert groups_found(make_docs(rows).repartition(7)) == groups_by_brute_force(rows)


def test_near_copies_below_the_threshold_do_not_leave_the_join(spark, make_docs, monkeypatch):
    rng = random.Random(8)
    base, made = " ".join(f"w{rng.randrange(5000)}" for _ in range(200)), []
    plain = jaccard_join._block_pairs

    def counted(lists, bitmaps):
        pairs = plain(lists, bitmaps)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(jaccard_join, "_block_pairs", counted)
    rows = [(i, varied(rng, base, 3)) for i in range(400)]
    assert groups_found(make_docs(rows)) == groups_by_brute_force(rows)
    assert made[0] < 400 * 399 / 2 / 10


def test_groups_of_random_small_sets(spark, make_docs):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(12)))) for i in range(300)]
    assert groups_found(make_docs(rows)) == groups_by_brute_force(rows)


def test_bounds_never_drop_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**63, rng.integers(1, 300), dtype=np.uint64))
        y = np.unique(np.concatenate([x[rng.random(len(x)) < rng.uniform(0.7, 1)], rng.integers(0, 2**63, rng.integers(0, 40), dtype=np.uint64)]))
        import pyarrow as pa

        flipped = jaccard_join._flipped(pa.array([jaccard_join.parity_bitmap(x)]), pa.array([jaccard_join.parity_bitmap(y)]))
        assert flipped[0].as_py() <= len(np.setxor1d(x, y))
        common = len(np.intersect1d(x, y))
        if 100 * common >= 80 * (len(x) + len(y) - common) and len(y):
            assert set(x[: jaccard_join.prefix_length(len(x))].tolist()) & set(y[: jaccard_join.prefix_length(len(y))].tolist())
            assert 9 * common >= 4 * (len(x) + len(y))


def test_one_of_each_group_stays(spark, make_docs):
    base = " ".join(f"w{i}" for i in range(50))
    docs = make_docs([(5, base), (2, base), (9, base.upper()), (7, "other text that stays here"), (7, "other text that stays here"), (None, base), (None, "x"), (4, None)])
    kept = jaccard_join.one_of_each_group(docs.withColumn("other_id", F.lit(1)))
    assert sorted([r.doc_id for r in kept.collect()], key=repr) == sorted([2, 7, 4, None], key=repr)
    assert kept.columns == [*docs.columns, "other_id"]
    assert jaccard_join.one_of_each_group(make_docs([])).count() == 0


def test_of_near_copies_rows_are_chosen_by_their_text(spark, make_docs):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(7, b), (7, c), (1, a), (9, a), (9, "d " + b[3:]), (None, "x y z"), (None, "x y z"), (None, a), (3, c + " more"), (2, ""), (2, " "), (2, None)]
    kept = sorted((str(r.doc_id), (r.text or "")[:4]) for r in jaccard_join.one_of_each_group(make_docs(rows)).collect())
    assert kept == sorted([("7", "b0 b"), ("3", "c0 c"), ("1", "a0 a"), ("None", "x y "), ("2", ""), ("2", " "), ("2", "")])
    # different texts without id, and with one id
    odd = make_docs([(None, a), (None, b), (5, a + " z"), (5, c), (5, b)])
    assert sorted((str(r.doc_id), r.text[:2]) for r in jaccard_join.one_of_each_group(odd).collect()) == [("5", "a0"), ("5", "b0"), ("5", "c0")]


def test_components_of_any_shape(spark):
    rng = random.Random(2)
    names = [rng.getrandbits(62) for _ in range(400)]
    links = [(names[i], names[i + 1]) for i in range(150)]
    links += [(names[200], names[i]) for i in range(201, 300)]
    links += [(names[300 + i], names[300 + (i * 7) % 30]) for i in range(30)]
    found = {r.node: r.label for r in components.contracted(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            parent[find(a)] = find(b)
    assert set(found) == set(parent)
    pairs = {(find(n), label) for n, label in found.items()}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert components.contracted(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def packing_holds(pieces, rows, size=2048):
    """Each id of each row lies in one piece, sequences are gapless; gives the padding's share."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(doc_id, []).append([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    assert set(by_doc) == set(ids)
    for doc_id, texts in ids.items():
        if len(texts) == 1:
            at = 0
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert p.start == at and p.doc_tokens == len(texts[0]) and p.length > 0
                assert p.ids_crc32 == zlib.crc32(array("I", texts[0][at : at + p.length]).tobytes())
                at += p.length
            assert at == len(texts[0])
        else:
            assert sum(p.length for p in by_doc[doc_id]) == sum(map(len, texts))
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    padding = 0
    for parts in sequences.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
        n = sum(p.length for p in parts)
        assert n <= size
        padding += 0 if n & (n - 1) == 0 else size - n
    return padding / max(sum(p.length for p in pieces), 1)


def test_packing_of_given_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert packing_holds(packing.packed(docs.repartition(5), TOKENIZER).collect(), rows) < 0.01


def test_packing_of_odd_rows(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "a"), (4, "word " * 5000), (5, "<|endoftext|> x"), (6, "b " * 2047), (6, "b " * 2047), (7, "b " * 2046), (None, "no id here")]
    found = packing.packed(make_docs(rows).withColumn("ids", F.lit(1)), TOKENIZER).collect()
    packing_holds(found, rows)
    assert packing.packed(make_docs([]), TOKENIZER).count() == 0


def test_windows_bound_and_small_gaps():
    rng = random.Random(4)
    done = []
    windows = packing.Windows(done.append, size=100, slots=4, max_gap=3)
    total = 0
    for doc in range(500):
        n = rng.randrange(1, 260)
        total += n
        windows.add(doc, bytes(4 * n))
        assert len(windows.held) <= 4
    lengths = [sum(len(p[2]) for p in w) // 4 for w in done]
    assert min(lengths) >= 97 and max(lengths) == 100
    assert sum(lengths) + sum(len(p[2]) for w in windows.leftovers() for p in w) // 4 == total
    cut = list(packing.at_powers_of_two([(1, 0, bytes(4 * 70), 70), (2, 0, bytes(4 * 30), 30)]))
    assert [sum(len(p[2]) for p in w) // 4 for w in cut] == [64, 32, 4]


def test_encoder_equals_tokenizer_on_whole_texts():
    encode, rng = packing.encoder(TOKENIZER), random.Random(6)
    parts = ["a", "B", "é", "É", "ß", "Σ", "ж", "中", "'s", "'", "t", "1", "22", ".", ",", "!!", "%%", "&amp;", " ", "\n", "\t", "\x1c", "\x85", "İ", "J̌", "😀",
             "<|endoftext|>", "<|", "|>", "K", "ﬁ", "the", "tion", "º", "́", "ɐ", "<|ENDOFTEXT|>"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        assert encode(text.encode()) == array("I", encode.tokenizer.encode(text, add_special_tokens=False).ids).tobytes(), text


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(5, 64))
    vectors = [(i, [float(x) for x in centres[i % 5] + 0.4 * rng.normal(size=64)]) for i in range(400)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(60)]  # one vector very often
    vectors += [(20, None), (None, vectors[0][1]), (5000, [float("nan")] * 64), (5001, [0.0] * 63 + [None])]
    df = spark.createDataFrame([(*v, 1) for v in vectors], "vec_id bigint, embedding array<float>, code int")
    rows = hamming_search.codes(df)
    held = {r.vec_id: r.code & (2**64 - 1) for r in rows.collect()}
    found = hamming_search.nearest(rows, rows.where("vec_id % 20 = 0")).collect()
    wanted = set()
    for q in held:
        if q % 20 == 0:
            near = sorted((bin(held[q] ^ c).count("1"), v) for v, c in held.items() if v != q)[:10]
            wanted |= {(q, v, d, i + 1) for i, (d, v) in enumerate(near)}
    assert {tuple(r) for r in found} == wanted


def test_search_leaves_out_only_vectors_of_odd_length(spark):
    rng = np.random.default_rng(9)
    vectors = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(30)]
    schema = "vec_id bigint, embedding array<float>"
    rows = hamming_search.codes(spark.createDataFrame([*vectors, (100, []), (101, [1.0, 2.0]), (102, [1.0] * 9)], schema))
    assert {r.vec_id for r in rows.collect()} == set(range(30))
    assert {r.vec_id for r in hamming_search.codes(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema)).collect()} == {2}


@pytest.mark.parametrize("size", [70, 150])
def test_search_compares_all_dimensions(spark, size):
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(6, size))
    centres[:, :64] = centres[0, :64]  # the first dimensions say nothing
    vectors = np.array([centres[i % 6] + 0.3 * rng.normal(size=size) for i in range(240)], np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>")
    rows = hamming_search.staged(hamming_search.codes(df), "test")
    found = hamming_search.nearest(rows, rows.where("vec_id % 20 = 0")).collect()
    signs = vectors > vectors.astype(float).mean(axis=0)
    wanted = set()
    for q in range(0, 240, 20):
        near = sorted((int((signs[q] != signs[v]).sum()), v) for v in range(240) if v != q)[:10]
        wanted |= {(q, v, d, i + 1) for i, (d, v) in enumerate(near)}
    assert {tuple(r) for r in found} == wanted


def test_search_of_small_tables(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert hamming_search.nearest(*[hamming_search.codes(spark.createDataFrame([], schema))] * 2).count() == 0
    few = hamming_search.codes(spark.createDataFrame([(20, [1.0, 2.0]), (21, [2.0, 1.0]), (21, [2.0, 1.0])], schema))
    assert [(r.query_id, r.neighbor_id) for r in hamming_search.nearest(few, few.where("vec_id = 20")).collect()] == [(20, 21)]


def tree_rows(spark, rows):
    return spark.createDataFrame(rows, "tree bigint, node bigint, parent bigint, role string, text string, score double")


def test_best_branch_is_formatted(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "weak", 1.0), (1, 3, 1, "assistant", "strong", 5.0),
        (1, 4, 3, "user", "more", 3.0), (1, 5, 2, "user", "x", 1.0), (2, 7, None, None, None, None), (None, 1, None, "user", "u", 1.0),
        (3, 1, 99, "user", "orphan", 1.0), (4, 1, 2, "a", "circle", 1.0), (4, 2, 1, "a", "circle", 1.0),
    ]
    found = {r.tree: r for r in chat_trees.chats(tree_rows(spark, rows)).collect()}
    assert chat_trees.read_back(found[1].formatted) == [("user", "root"), ("assistant", "strong"), ("user", "more")]
    assert [found[1].formatted[s.start : s.end] for s in found[1].loss_spans] == ["strong"]
    assert chat_trees.read_back(found[2].formatted) == [("", "")]
    assert set(found) == {1, 2, 3, None}
    assert chat_trees.chats(tree_rows(spark, [])).count() == 0


def test_long_and_wide_trees(spark):
    rng = random.Random(9)
    rows = [(1, 0, None, "user", "0", 0.5)] + [(1, i, rng.randrange(max(0, i - 3), i), "user", str(i), rng.random()) for i in range(1, 120)]
    rows += [(2, i, i - 1 if i else None, "assistant", str(i), 0.0) for i in range(77)]
    found = {r.tree: r.formatted for r in chat_trees.chats(tree_rows(spark, rows)).collect()}
    parent, score = {r[1]: r[2] for r in rows if r[0] == 1}, {r[1]: r[5] for r in rows if r[0] == 1}
    paths = []
    for leaf in set(parent) - set(parent.values()):
        path = [leaf]
        while parent[path[-1]] is not None:
            path.append(parent[path[-1]])
        paths.append((round(-sum(score[n] for n in path) / len(path), 9), -len(path), leaf, path[::-1]))
    assert [t for _, t in chat_trees.read_back(found[1])] == [str(n) for n in min(paths)[3]]
    assert [t for _, t in chat_trees.read_back(found[2])] == [str(i) for i in range(77)]


def test_conversations_with_repeated_and_null_rows(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", None), (None, 3, None, "b"), (1, 1, "assistant", "x\n### user: </turn>\n\\")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, node int")
    found = {r.tree: chat_trees.read_back(r.formatted) for r in chat_trees.chats(chat_trees.linear(df)).collect()}
    assert found == {1: [("system", ""), ("user", "a"), ("user", "a"), ("assistant", rows[4][3])], None: [("", "b")]}


def test_template_is_reversible_for_any_text():
    rng = random.Random(10)
    parts = ["\\", "#", "###", " ", ":", ": ", "</turn>", "<", "/turn>", "\n", "assistant", "user", "### assistant: ", "<\\/turn>", "é"]
    for _ in range(3000):
        turns = [(rng.choice(["user", "assistant", "a: b", "x\\", ""]), "".join(rng.choice(parts) for _ in range(rng.randrange(12)))) for _ in range(rng.randrange(5))]
        text, spans = chat_trees.formatted(turns)
        assert chat_trees.read_back(text) == turns
        assert [chat_trees.unescaped(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
        assert not any(mark in text[a:b] for a, b in spans for mark in ("#" * 3, "</turn>"))


def budgets(spark, leaves, share, epochs, weights):
    df = spark.createDataFrame(leaves, "domain string, language string, source string, tokens bigint")
    return {(r.domain, r.language, r.source): r.budget for r in mixing.leaf_budgets(df, share, epochs, weights).collect()}


def test_shortages_go_to_siblings_first(spark):
    leaves = [("a", "en", "s1", 10), ("a", "en", "s2", 1000), ("a", "de", "s1", 50), ("b", "en", "s1", 3000)]
    found = budgets(spark, leaves, 0.5, 1, {"domain": {"a": 3, "b": 1}})
    # a's share is 1522, but it has 1060 tokens: all of them; b gets the rest
    assert found == {("a", "en", "s1"): 10, ("a", "en", "s2"): 1000, ("a", "de", "s1"): 50, ("b", "en", "s1"): 970}
    found = budgets(spark, leaves, 0.1, 1, {"domain": {"a": 3, "b": 1}})
    # a has 304: en 254 of them as de has 50 only, s2 what s1 cannot give
    assert found == {("a", "en", "s1"): 10, ("a", "en", "s2"): 244, ("a", "de", "s1"): 50, ("b", "en", "s1"): 101}


def test_mixture_equals_sql_and_budget(spark, make_docs):
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    names = ["doc_id", "domain", "language", "source", "epoch"]
    wanted = sorted(tuple(r) for r in con.sql(f"select {', '.join(names)} from ({mixing.SQL})").fetchall())
    assert sorted(tuple(r) for r in mixing.query(spark, FOLDER).select(names).collect()) == wanted


def test_mixture_of_odd_rows(spark, make_docs):
    rows = [(1, "a b c", "en", "s1"), (1, "a b c", "en", "s1"), (2, None, "en", "s1"), (3, "", None, None), (None, "x y", None, "s2"), (4, "q " * 3000, "de", "s1")]
    docs = make_docs(rows).withColumn("mix", F.lit(0)).withColumn("epochs", F.lit(0))
    found, name = mixing.mixed_rows(docs, mixing.document_keys(), share=1.0, max_epochs=1)
    assert sorted((r.doc_id for r in found.collect()), key=repr) == sorted([1, 1, 2, 4, None], key=repr)
    assert name != "mix" and {"mix", "epochs"} <= set(found.columns)
    nothing, _ = mixing.mixed_rows(docs, mixing.document_keys(), share=0.0)
    assert all((r.text or "") == "" for r in nothing.collect())
    empty, _ = mixing.mixed_rows(make_docs([]), mixing.document_keys())
    assert empty.count() == 0


@pytest.mark.parametrize("epochs", [1, 3])
def test_leaves_keep_to_their_budgets(spark, make_docs, epochs):
    rng = random.Random(12)
    rows = [(i, "t " * rng.randrange(1, 40), rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b", "c1"])) for i in range(600)]
    docs = make_docs(rows)
    plan = mixing.leaf_plan(docs, mixing.document_keys(), share=0.7 * epochs, max_epochs=epochs).collect()
    found, name = mixing.mixed_rows(docs, mixing.document_keys(), share=0.7 * epochs, max_epochs=epochs)
    taken = Counter()
    for r in found.select("text", f"{name}.*").collect():
        taken[r.domain, r.language, r.source] += len(r.text.split())
    for leaf in plan:
        assert leaf.budget - 40 < taken[leaf.domain, leaf.language, leaf.source] <= leaf.budget
