"""Archives, alignment and collocations: odd rows, and brute-force versions written another way."""

import base64
import gzip
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from checks.compare import connect, rows_of
from shipflux.llm import alignment, collocations, queries, warc
from shipflux.session import staged


@pytest.mark.parametrize("name", ["op11_warc", "op13_collocations"])
def test_query_matches_sql(spark, sf_dir, name):
    cursor = connect(sf_dir).execute(queries.ORACLE_SQL[name])
    wanted = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    df = queries.QUERIES[name](spark, sf_dir)
    assert rows_of(df.columns, df.collect()) == wanted


# ---- op11 ----

PAGES = [
    (7, "http://a.org/x?q=1#part", "<p>one</p>"),
    (3, "http://b.org", "<p>one</p>"),
    (9, None, "<p>one</p>"),
    (4, "http://c.org/\r\nEvil: 1", ""),
    (5, "http://c.org/ü", None),
    (None, "http://d.org/", "no id"),
    (6, "http://e.org/", "WARC/1.1\r\n\r\nWARC-Type: response\r\n\r\n\r\n\r\nWARC/1.1\r\n"),
    (8, "http://f.org/", "long ä " * 600_000),
    (8, "http://f.org/", "long ä " * 600_000),
]


def archived(spark, rows, **options):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, payload int, digest string, found string, id int")
    stretches = warc.write(frame, **options)
    return stretches, staged(warc.read(stretches, payload=True), "read")


def facts(records):
    captures = warc.payload_facts(warc.assemble(records))
    return captures.select(
        warc.first_fields(F.col("metadata"))["id"].alias("id"), "target_uri", "payload_bytes", "payload_digest",
        F.col("record.type").alias("type"), F.col("same_payload.fields")["id"].alias("same"), F.size("requests").alias("requests"),
    )


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("limits", [{}, {"archive_bytes": 900, "slice_bytes": 1}])
def test_archives_keep_every_payload(spark, limits):
    clashing = [(*row, 1, "x", "y", 2) for row in PAGES]
    stretches, records = archived(spark, clashing, **limits)
    found = {r["id"]: r for r in facts(records).collect()}
    first = {3: "response", 4: "response", None: "response", 6: "response", 8: "response"}
    same = {7: "3", 9: "3", 5: "4"}
    assert len(found) == 8
    for page_id, _, html in PAGES:
        row = found[None if page_id is None else str(page_id)]
        assert (row["payload_bytes"], row["payload_digest"]) == (len((html or "").encode()), sha1(html))
        assert row["type"] == first.get(page_id, "revisit") and row["same"] == same.get(page_id) and row["requests"] == 1
    assert found["4"]["target_uri"] == "http://c.org/%0D%0AEvil: 1" and found["9"]["target_uri"] is None
    kept = {r["payload"] for r in records.filter("type = 'response'").select(F.col("payload").cast("string").alias("payload")).collect()}
    assert kept == {html or "" for _, _, html in PAGES}
    for path in {r["path"] for r in stretches.collect()}:
        content = gzip.open(path).read()
        assert content.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and content.endswith(b"\r\n\r\n")


def test_archives_without_pages(spark):
    _, records = archived(spark, [])
    assert facts(records).count() == 0


def written(tmp_path, name, *records, members=True):
    pack = gzip.compress if members else bytes
    (tmp_path / name).write_bytes(b"".join(map(pack, records)) if members is not None else gzip.compress(b"".join(records)))


def record(kind, own, block=b"", **fields):
    names = {k.replace("_", "-"): v for k, v in fields.items()}
    return warc.head([("WARC-Type", kind), ("WARC-Record-ID", f"<{own}>"), *names.items()], block)


@pytest.mark.parametrize("members", [True, False, None])
def test_foreign_archives(spark, tmp_path, members):
    """Links in both directions and through a third record; records without capture; revisits of absent records."""
    http = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"
    media = {"Content_Type": "application/http"}
    written(
        tmp_path,
        "a.warc.gz" if members is not False else "a.warc",
        record("warcinfo", "i", b"x: 1\r\n"),
        record("request", "q", b"GET / HTTP/1.1\r\n\r\n", **media),
        record("response", "r", http, WARC_Concurrent_To="<q>", **media),
        record("metadata", "m", b"id: 5\r\n", WARC_Concurrent_To="<q>", Content_Type="application/warc-fields"),
        record("metadata", "alone", b"id: 6\r\n", WARC_Concurrent_To="<gone>", Content_Type="application/warc-fields"),
        record("revisit", "v", b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n", WARC_Refers_To="<gone>",
               WARC_Payload_Digest="sha1:abc", **media),
        members=members,
    )
    (tmp_path / "other.txt").write_bytes(b"no archive")
    records = staged(warc.read(warc.archives(spark, str(tmp_path)), payload=True), "read")
    captures = {r["capture_id"]: r for r in warc.payload_facts(warc.assemble(records)).collect()}
    assert set(captures) == {"r", "alone", "v"}
    whole = captures["r"]
    assert bytes(whole["record"]["payload"]) == b"abc" and whole["payload_bytes"] == 3
    assert [e["record_id"] for e in whole["requests"]] == ["q"] and whole["metadata"][0]["fields"] == {"id": "5"}
    assert captures["alone"]["record"] is None and captures["alone"]["metadata"][0]["fields"] == {"id": "6"}
    assert (captures["v"]["payload_bytes"], captures["v"]["payload_digest"], captures["v"]["same_payload"]) == (9, "ABC", None)


def test_cut_off_archives_are_errors(tmp_path):
    whole = gzip.compress(record("response", "r", b"x" * 500))
    for name, content in (("a.warc.gz", whole[:-9]), ("b.warc", gzip.decompress(whole)[:100]), ("c.warc", b"something else\r\n\r\n")):
        (tmp_path / name).write_bytes(content)
        with pytest.raises(ValueError, match=name):
            list(warc.stretch_records(str(tmp_path / name), 0, None, False))


def test_attached_by_shuffle(spark, monkeypatch):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 5 != 0, F.concat(F.lit("k"), F.col("id") % 700)).alias("key"), F.col("id").alias("own_id"))
    side = staged(rows.filter("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("count"), F.struct(F.max("own_id").alias("top")).alias("found")), "side")
    small = warc.attached(rows, side, "key", 4000).select("own_id", "found.top")
    monkeypatch.setattr(warc, "SMALL_BYTES", 0)
    large = warc.attached(rows, side, "key", 4000).select("own_id", "found.top")
    assert sorted(map(tuple, small.collect()), key=str) == sorted(map(tuple, large.collect()), key=str)
    assert small.count() == 4000 and small.filter("top IS NULL").count() == 400


# ---- op12 ----


@pytest.fixture(scope="module")
def tokenizers():
    files = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.Tokenizers.read(*files)


def plain_alignment(texts):
    """doc_id to (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), with the libraries' own encoders and sets of bytes."""
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_of_letter()

    def spans(pieces):
        at, out = 0, []
        for token, piece in pieces:
            out.append((token, at, at + len(piece)))
            at += len(piece)
        return out

    done, holders = {}, Counter()
    for doc_id, text in texts:
        a = [(i, bytes(letters[c] for c in bpe.id_to_token(i))) for i in bpe.encode(f" {text or ''}", add_special_tokens=False).ids]
        b = []
        for i in model.encode(text or ""):
            piece = model.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = f" {text}".encode()
        if not text or b"".join(p for _, p in a) != whole or b"".join(p for _, p in b) != whole:
            done[doc_id] = None
            continue
        a, b = spans(a), spans(b)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, before = [], 0
        for cut in cuts:
            sides = [",".join(str(t) for t, s, e in side if before <= s and e <= cut) for side in (a, b)]
            groups.append("|".join(sides))
            before = cut
        links = [(x, y) for x, s, e in a for y, t, f in b if max(s, t) < min(e, f)]
        holders.update(set(links))
        done[doc_id] = (len(a), len(b), len(cuts), links, ";".join(groups))
    best = defaultdict(int)
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    rows = set()
    for doc_id, found in done.items():
        if found is None:
            rows.add((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, groups = found
        sums = sum(holders[p] == best[p[0]] for p in links), sum(holders[p] for p in links)
        rows.add((doc_id, n_a, n_b, n_groups, len(links), *sums, hashlib.sha256(groups.encode()).hexdigest()))
    return rows


ODD_TEXTS = [
    None, "", " ", "  two  spaces ", "▁ stays", "<|endoftext|> <s> </s> <unk>", "naïve 中文字 ​🙂🙂", "\x00\x01 \t\n\r\n", "İstanbul ﬁ é",
    "It's we'll 12345 ...", "x" * 400, "same text", "same text", "a b　c", "﻿bom",
]


def test_alignment_against_all_pairs_of_tokens(spark, sf_dir, tokenizers):
    documents = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy(F.length("text"), "doc_id").limit(60).collect()]
    texts = [*documents, *((-1 - i, t) for i, t in enumerate(ODD_TEXTS))]
    frame = spark.createDataFrame([(*t, 1, 2) for t in texts], "doc_id long, text string, row int, pairs int")
    for frequent in (alignment.FREQUENT_PAIRS, 40, 0):
        found = alignment.align(frame, tokenizers, frequent=frequent)
        assert {tuple(r) for r in found.collect()} == plain_alignment(texts)


def test_alignment_merges_ends_as_they_come(monkeypatch):
    """Both lists of ends are ascending, so no set of them is hashed or sorted again; the result is that of sets."""
    rng = np.random.default_rng(3)
    sides = [(np.array([4]), np.array([4])), *(([np.append(np.flatnonzero(rng.random(60) < p) + 1, 61) for p in (0.3, 0.6)]) for _ in range(30))]
    wanted = []
    for a, b in sides:
        ends, shared = sorted({*a.tolist(), *b.tolist()}), sorted({*a.tolist()} & {*b.tolist()})
        linked = [[int(np.sum(x < e)) for e in ends] for x in (a, b)]
        wanted.append([[int(np.sum(a <= e)) for e in shared], [int(np.sum(b <= e)) for e in shared], *linked])
    for name in ("union1d", "unique", "intersect1d"):
        monkeypatch.setattr(np, name, None)
    for (a, b), expected in zip(sides, wanted, strict=True):
        found = alignment.aligned(a, b)
        assert [x.tolist() for x in (found.a_cuts, found.b_cuts, found.a_linked, found.b_linked)] == expected


def test_alignment_of_odd_tables(spark, tokenizers):
    schema = "doc_id long, text string"
    assert alignment.align(spark.createDataFrame([], schema), tokenizers).count() == 0
    twice = alignment.align(spark.createDataFrame([(1, "ab cd"), (1, "ab cd"), (None, "ab cd")], schema), tokenizers).collect()
    assert len(twice) == 3 and len({tuple(r)[1:] for r in twice}) == 1 and twice[0]["count_sum"] == 3 * twice[0]["n_links"]
    broken = spark.createDataFrame([(1,)], "doc_id long").withColumn("text", F.expr("cast(X'61FF62' as string)"))
    assert tuple(alignment.align(broken, tokenizers).first())[1:] == (0, 0, 0, 0, 0, 0, "")
    long_text = "word größer " * 100_000
    row = alignment.link(spark.createDataFrame([(1, long_text)], schema), tokenizers, groups=True).first()
    assert row["n_groups"] == row["groups"].count(";") + 1 and row["n_a"] > 200_000


# ---- op13 ----


def plain_collocations(rows, threshold, best):
    import re

    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, 6):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = set()
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if len(p) > 1 and n >= threshold}
        rated = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in candidates.items()):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rated.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rated)[:best], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def invented(seed, texts=300):
    """Few words, so that many phrases repeat; odd signs between them."""
    rng = random.Random(seed)
    words = ["Ab", "c", "dé", "ÉÀ", "ee", "f", "\xa0g", "\x1fh", "i-j"]
    joins = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "?\r\n", " ; ", "\x0b"]
    rows = [(rng.choice(["en", "en", "", None]), "".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randrange(40)))) for _ in range(texts)]
    return [*rows, ("en", None), (None, ""), ("de", " . , "), ("en", "ab c dé " * 5000), ("en", "f f f f f f f f f")]


@pytest.mark.parametrize("capacity", [collocations.CAPACITY, 200])
def test_collocations_against_plain_counting(spark, capacity):
    """With few counters there are many hash partitions, and summaries that give up counters."""
    rows = invented(5)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, count int, phrase string")
    found = collocations.collocations(frame.repartition(3), threshold=12, best=40, capacity=capacity)
    assert {tuple(r) for r in found.collect()} == plain_collocations(rows, 12, 40)


def test_collocations_by_salted_joins(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SMALL_BYTES", 0)
    rows = invented(6, 100)
    found = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), threshold=9, best=1000)
    assert {tuple(r) for r in found.collect()} == plain_collocations(rows, 9, 1000)


def test_collocations_without_words(spark):
    for rows in ([], [(None, None), ("en", " ,. ")]):
        assert collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).count() == 0


def test_large_products_are_exact(spark):
    """1000 a n passes 64 bits."""
    a, n, left, right = 3_000_000_019, 9_000_000_000_000_001, 5_000_000_029, 4_000_000_007
    counts = [("en", None, 0, n), ("en", "a", 1, left), ("en", "b", 1, right), ("en", "a b", 2, a)]
    row = collocations.scored(staged(spark.createDataFrame(counts, "lang string, phrase string, words int, f long"), "c")).first()
    assert row["score"] == 1000 * a * n // (left * right)


def test_summaries_lose_nothing_frequent():
    rng = np.random.default_rng(1)
    stream = np.concatenate([np.repeat(np.arange(1, 9, dtype=np.uint64), 100), rng.integers(10, 10_000, 30_000).astype(np.uint64)])
    rng.shuffle(stream)
    summary = collocations.MisraGries(len(stream) // 100 + 1, 100)
    for part in np.array_split(stream, 50):
        hashes, counts = np.unique(part, return_counts=True)
        summary.merge([hashes], [counts])
        assert summary.error < 100
    assert set(range(1, 9)) <= set(summary.frequent().tolist()) and len(summary.hashes) <= summary.capacity
