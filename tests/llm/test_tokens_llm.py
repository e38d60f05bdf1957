"""BPE against tiktoken; decontamination, dedup, near duplicates and search against brute force."""

import base64
import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from shipflux.llm import bpe, common, mtree, near, passages, suffixes
from shipflux.llm.queries import VOCABULARY, op2_bpe

TEXTS = [
    (1, None), (2, ""), (3, "a b  \u3000\n\n x y'll we're 日本語 \U0001f600e\u0301 12½٣ 'tis\r\n\t\x0b\x85z"), (4, "a" * 400),
    (5, " " * 50 + "x"), (6, "the cat the cat the cat"), (6, "the cat the cat the cat"), (7, "<|endoftext|>\ufffe\uffff thndreou"),
]


@pytest.mark.parametrize("dictionary", [0, 3, 1000])
def test_bpe_equals_tiktoken(spark, dictionary):
    path = public_tokenizers.path(VOCABULARY)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    real = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.codec(spark, path, public_tokenizers.PATTERN)
    docs = spark.createDataFrame([(i, t, b"x") for i, t in TEXTS], "doc_id long, text string, ids binary")
    encoded = bpe.encode(docs, codec, dictionary=dictionary)
    rows = encoded.withColumn("back", codec.decode(F.col("ids"))).collect()
    assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((i, t or "") for i, t in TEXTS)
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == real.encode_ordinary(r.text or "")
        assert bytes(r.back).decode() == (r.text or "")
    digest = {r.doc_id: r for r in bpe.digests(encoded, codec).collect()}
    assert digest[1].n_tokens == 0 and digest[1].ids_sha256 == digest[2].decoded_sha256 == hashlib.sha256().hexdigest()


def test_bpe_encodes_and_decodes_in_one_python_worker(spark):
    codec = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    once = bpe.round_trip_digests(docs, codec)
    assert sorted(once.collect()) == sorted(bpe.digests(bpe.encode(docs, codec), codec).collect())
    plan = op2_bpe(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"^[ +:*()0-9-]*ArrowEvalPython", plan, re.M)) == 1


def test_workers_take_texts_in_slices(spark, monkeypatch):
    """Parts of bounded bytes and longer single texts, in order; a slice of a batch is encoded as the whole is."""
    texts = pa.array(["ab", None, "", "é" * 9, "a", "b" * 8, None], pa.string())
    parts = [part.to_pylist() for part in common.slices(texts, texts, 10)]
    assert parts == [["ab", None, ""], ["é" * 9], ["a", "b" * 8, None]]
    assert not list(common.slices(texts[:0], texts[:0], 10))
    assert [len(part) for part in common.slices(texts[1:3], texts[1:3], 10)] == [2]

    handled = []
    monkeypatch.setattr(bpe.F, "arrow_udf", lambda kind: lambda run: lambda text: handled.extend(map(len, run(iter([text])))))
    codec = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    codec.round_trip(pa.array(["some words " * 10_000] * 200), 1000)
    assert len(handled) > 4 and sum(handled) == 200


def test_decontamination_takes_one_python_worker(spark):
    """A task searches the last block of items and finishes in one worker, which gives no texts back."""
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([("x", "a b"), ("y", "c")], "item_id string, text string")
    for block, passes in ((suffixes.BLOCK_WORDS, 1), (1, 2)):
        found = suffixes.contamination(docs, items, block_words=block)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall(r"^[ +:*()0-9-]*MapInArrow", plan, re.M)) == passes
        assert [(r.n_words, r.items) for r in found.collect()] == [(2, ["x"])]


def test_a_comparison_of_blocks_takes_bounded_memory():
    """Two full blocks of dissimilar texts: matrices of a few million numbers, whatever the texts share."""
    import tracemalloc

    rng = np.random.default_rng(1)
    texts = [(np.unique(rng.integers(0, 200_000, 900).astype(np.uint64)),) for _ in range(2 * near.BLOCK_MEMBERS)]
    texts = [(t, np.ones(len(t), dtype=np.int64)) for (t,) in texts]
    tracemalloc.start()
    near.ceilings(texts, np.arange(near.BLOCK_MEMBERS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_bpe_of_an_empty_table(spark):
    codec = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    assert bpe.encode(spark.createDataFrame([], "doc_id long, text string"), codec).count() == 0


DOC = "doc_id long, text string, bad string, gone string"
WORDS = "a b c d e f g h i j k l m n o p q r s t u v w x y z".split()


def plain(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contaminated_by_hand(docs, items):
    seen = defaultdict(set)
    for item, text in items:
        words = plain(text)
        size = min(13, len(words))
        for at in range(len(words) - size + 1 if words else 0):
            seen[tuple(words[at : at + size])].add(str(item))
    out = []
    for doc, text in docs:
        words = plain(text)
        hit, found = [False] * len(words), set()
        for window, owners in seen.items():
            for at in range(len(words) - len(window) + 1):
                if tuple(words[at : at + len(window)]) == window:
                    found |= owners
                    hit[at : at + len(window)] = [True] * len(window)
        n = sum(hit)
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(words), n, len(found), digest, n > 0 and 20 * n >= len(words)))
    return sorted(out)


def test_contamination_by_hand_and_in_blocks(spark):
    alphabet = " ".join(WORDS)
    items = [
        (1, alphabet), (2, "short Item"), (3, None), (4, "..."), (10, "b c d e f g h i j k l m n"),
        (2, "short Item"), (5, "Ünï é 日本 x"), (6, "solo"),
    ]
    docs = [
        (1, alphabet), (2, "zero " + alphabet.upper() + " one"), (3, None), (4, ""), (5, "A SHORT item, indeed"),
        (6, "a b c d e f g h i j k l"), (7, "w " * 2000 + "b,c;d e f g h i j k l m n"), (7, "other text of the id"),
        (8, "ünï é 日本 x"), (9, "Ünï é 日本 x solo"), (None, alphabet), (10, "b c d e f g h i j k l m n " * 3), (10, "b c d e f g h i j k l m n " * 3),
    ]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOC)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    expected = contaminated_by_hand([(-1 if i is None else i, t) for i, t in docs], items)
    for block in (suffixes.BLOCK_WORDS, 3):
        found = suffixes.contamination(table, benchmark, block_words=block)
        rows = found.select(
            F.coalesce("doc_id", F.lit(-1)), "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
        ).collect()
        assert sorted(tuple(r) for r in rows) == expected
    longest = {r.doc_id: r for r in found.collect()}
    assert longest[1].longest_match == 26 and longest[1].longest_at == 0
    kept = suffixes.decontaminate(table, benchmark)
    assert kept.columns == table.columns
    bad = {d for d, *_, c in expected if c and d != -1}
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(i or -1 for i, _ in docs if i not in bad)


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert suffixes.contamination(none, items).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.contaminated) for r in suffixes.contamination(one, items).collect()] == [(2, False)]


def passages_by_hand(docs, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    first = {}
    for i, w in words:
        for at in range(len(w) - size + 1 if i is not None else 0):
            key = tuple(w[at : at + size])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for at in range(len(w) - size + 1 if i is not None else 0):
            if first[tuple(w[at : at + size])] < i:
                gone[at : at + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((-1 if i is None else i, kept, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("bits", [4, 10, 20])
def test_passages_by_hand(spark, bits):
    rng = np.random.default_rng(3)
    run = " ".join(WORDS[:20])
    docs = [
        (1, None), (2, ""), (3, run), (4, run), (4, "x " + run + " y"), (5, "same " * 40), (6, "same " * 40), (7, run[:20]),
        (8, "\u00a0a\x1cb " + run + "\t" + run), (None, run), (9, run + "."), (10, "ü " * 30), (11, run),
    ]
    docs += [(20 + k, " ".join(rng.choice(["u", "v"], 60))) for k in range(30)]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOC).repartition(3)
    rows = passages.dedup(table, length=5, bits=bits).collect()
    found = sorted((-1 if r.doc_id is None else r.doc_id, *r[1:]) for r in rows)
    assert found == passages_by_hand(docs, 5)


def test_gaps_of_cells_round_trip():
    for cells in ([0], [5], [0, 1, 255, 256, 511, 2000], [], list(range(0, 100_000, 253))):
        held = np.array(cells, dtype=np.int64)
        assert passages.unpacked(passages.packed(held)).tolist() == cells


def jaccard(a, b):
    p = {k: v / sum(a.values()) for k, v in a.items()}
    q = {k: v / sum(b.values()) for k, v in b.items()}
    every = set(p) | set(q)
    return sum(
        1 / sum(max(p.get(e, 0) / p[d], q.get(e, 0) / q[d]) for e in every) for d in set(p) & set(q)
    )


def shingled(text):
    words = plain(text)
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else Counter()


def test_probability_jaccard_and_its_estimate():
    rng = np.random.default_rng(5)
    for _ in range(20):
        a = " ".join(rng.choice(WORDS[:4], 60))
        b = " ".join([*a.split()[: rng.integers(20, 60)], *rng.choice(WORDS[:4], 8)])
        sides = [near.shingles([w.encode() for w in t.split()], 5) for t in (a, b)]
        exact = jaccard(shingled(a), shingled(b))
        assert math.isclose(near.probability_jaccard(*sides), exact, rel_tol=1e-9)
        x, y = near.signatures(sides, 4096)
        assert abs((x == y).mean() - exact) < 0.05


def test_near_classes_by_hand(spark):
    rng = np.random.default_rng(11)
    base = [str(w) for w in rng.integers(0, 10**6, 200)]
    docs = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two!"), (6, "one two three"), (None, " ".join(base))]
    docs += [(900 + i, " ".join(base)) for i in (0, 1, 2)]
    for i in range(40):  # copies with edits: not all pairs are similar enough
        words = list(base)
        for at in rng.choice(200, 2, replace=False):
            words[at] = f"new{i}{at}"
        docs.append((100 + i, " ".join(words)))
    docs += [(300 + i, " ".join(str(w) for w in rng.integers(0, 10**6, 50))) for i in range(20)]
    docs += [(4, "one two")]
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOC)
    named = {i: shingled(t) for i, t in docs if i is not None}
    root = {i: i for i in named}

    def end(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in named:
        for j in named:
            if i < j and named[i] and named[j] and jaccard(named[i], named[j]) >= 0.8:
                root[max(end(i), end(j))] = min(end(i), end(j))
    rows = near.classes(table).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: r.class_id for r in rows} == {**{i: end(i) for i in named}, None: None}
    kept = near.keep_first(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(
        i or -1 for i, _ in docs if i is None or end(i) == i
    )


def test_stars_and_strays_lose_no_link(spark):
    """A bucket whose members are only linked through each other is still compared in full."""
    members = spark.createDataFrame(
        [(7, i, 10, 1 if i < 5 else i) for i in range(1, 9)], "key long, id long, words long, root long"
    )
    sized = near.sized(members)
    assert {r.members for r in sized.collect()} == {8}
    pairs = {tuple(r) for r in near.strays(sized).select("a", "b").collect()}
    roots = {r.id: r.root for r in members.collect()}
    every = {(a, b) for a in roots for b in roots if a < b and roots[a] != roots[b]}
    assert pairs == every
    assert near.stars(members, 0).count() <= 8
    for block, words in ((1, 10**6), (2, 10**6), (100, 10**6), (100, 25)):
        cells = {}
        for r in near.dealt(sized, block, words).collect():
            cells.setdefault((r.key, r.x, r.y), []).append(r)
        met = [
            (min(a.id, b.id), max(a.id, b.id))
            for (_, x, y), rows in cells.items()
            for a in rows
            for b in rows
            if a.left and a.root != b.root and (not b.left or (y == x + 1 and a.id < b.id))
        ]
        assert set(met) == every and len(met) == len(every)


def test_ceilings_hold_and_are_the_similarity_of_texts_without_repeats():
    rng = np.random.default_rng(9)
    repeating = [" ".join(rng.choice(WORDS[:5], rng.integers(5, 60))) for _ in range(12)]
    base = [str(i) for i in range(80)]
    edited = [" ".join(str(1000 + i) if rng.random() < 0.05 else w for i, w in enumerate(base)) for _ in range(12)]
    for texts, exactly in ((repeating, False), (edited, True)):
        sets = [near.shingles([w.encode() for w in t.split()], 5) for t in texts]
        left = np.array([0, 3, 7])
        most = near.ceilings(sets, left)
        for i, one in enumerate(left):
            for j in set(range(len(sets))) - {one}:
                exact = near.probability_jaccard(sets[one], sets[j])
                assert most[i, j] >= exact - 1e-4
                assert not exactly or abs(most[i, j] - exact) < 1e-4


def test_large_buckets_equal_brute_force(spark, monkeypatch):
    """Near copies of one text in families of links, compared by blocks of few members."""
    monkeypatch.setattr(near, "SMALL_BUCKET", 2)
    monkeypatch.setattr(near.dealt, "__defaults__", (4, 10**6))
    rng = np.random.default_rng(3)
    base = [str(i) for i in range(60)]
    docs = []
    for i in range(60):
        words = list(base)
        for at in rng.choice(60, rng.integers(0, 4), replace=False):
            words[at] = f"new{i}x{at}"
        docs.append((i, " ".join(words * (2 if i % 7 == 0 else 1))))
    named = {i: shingled(t) for i, t in docs}
    root = {i: i for i in named}

    def end(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in named:
        for j in named:
            if i < j and jaccard(named[i], named[j]) >= 0.8 - 1e-12:
                root[max(end(i), end(j))] = min(end(i), end(j))
    rows = near.classes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: end(i) for i in named}
    assert len(set(map(end, named))) > 2


def best_by_hand(rows, queries, k):
    whole = {}
    usable = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in usable:
        if q in queries and q not in whole:
            whole[q] = min(w for i, w in usable if i == q)
            scores = sorted((-sum(a * b for a, b in zip(whole[q], w)), i) for i, w in usable if i != q and len(w) == len(whole[q]))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [1, 1000])
def test_search_by_hand(spark, block):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(600)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]
    rows += [(2000, None), (2100, [None] * 6), (2200, [float("nan")] * 6), (2300, [float("inf")] * 6), (2400, [1.0, 2.0]), (2500, [0.0] * 6), (None, [1.0] * 6), (2600, []), (100, rows[100][1])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string").repartition(3)
    asked = table.filter("vec_id % 100 = 0")
    as_float = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    expected = best_by_hand(as_float, {i for i, _ in rows if i is not None and i % 100 == 0}, 10)
    found = mtree.top_k(table, asked, block=block if block > 1 else 9)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_tree_leaves_out_what_cannot_win():
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(4000, 4)) * 100).astype(np.int64)
    norms = np.square(vectors.astype(float)).sum(axis=1)
    points = np.concatenate([vectors, np.sqrt(norms.max() - norms)[:, None]], axis=1)
    root = mtree.grow(points)

    class Counted(np.ndarray):
        seen = 0

        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                Counted.seen += len(key)
            return super().__getitem__(key)

    best = mtree.search(root, vectors.view(Counted), np.arange(4000), vectors[7], 7, float(norms.max()), 10)
    scores = vectors @ vectors[7]
    assert best == sorted(((int(s), i) for i, s in enumerate(scores) if i != 7), key=lambda m: (-m[0], m[1]))[:10]
    assert Counted.seen < 2000
