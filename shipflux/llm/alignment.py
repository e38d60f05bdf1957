"""Cross-tokenizer alignment: where the tokens of a byte-level BPE (A) and of a piece BPE (B) end together.

Both encode a space and the text. The byte offsets at which a token ends are the
keys of one dictionary per side, with the number of tokens up to there as values.
Keys of both dictionaries, in order, cut the two id lists into groups; inside a
group every stretch between neighbouring ends lies in one token of either side,
which links the two. Link counts are corpus-wide, so they are counted in Spark.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import share
from shipflux.session import staged

# Fixed value: the pattern that splits a text before the merges of the byte-level BPE.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# At most so many pairs, the most frequent ones, are broadcast; the others meet their counts by shuffle.
FREQUENT_PAIRS = 1 << 19
# A pair of ids is one number: A's id times this, plus B's id.
PAIR_BASE = 1 << 32


def byte_of_letter() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for.

    Visible Latin-1 characters stand for themselves, the other bytes in order for U+0100 and after.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {**{chr(b): b for b in visible}, **{chr(0x100 + i): b for i, b in enumerate(hidden)}}


@dataclass
class Tokenizers:
    """The two tokenizers, as file contents of fixed size; built where they are used."""

    byte_bpe: bytes
    piece_bpe: bytes

    @classmethod
    def read(cls, byte_bpe_path: str, piece_bpe_path: str) -> Tokenizers:
        """Of a byte-level BPE as JSON, and a piece BPE with byte fallback as a sentencepiece model."""
        with open(byte_bpe_path, "rb") as a, open(piece_bpe_path, "rb") as b:
            return cls(a.read(), b.read())

    def __getstate__(self):
        return {"byte_bpe": self.byte_bpe, "piece_bpe": self.piece_bpe}

    @cached_property
    def a_bytes(self) -> list[bytes]:
        content = json.loads(self.byte_bpe)
        letters = byte_of_letter()
        special = {t["id"] for t in content["added_tokens"]}
        tokens = {i: bytes(letters[c] for c in t) for t, i in content["model"]["vocab"].items() if i not in special}
        return [tokens.get(i, b"") for i in range(max(tokens) + 1)]

    @cached_property
    def b_bytes(self) -> list[bytes]:
        model = self.pieces
        return [
            bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in ((i, model.id_to_piece(i)) for i in range(model.get_piece_size()))
        ]

    @cached_property
    def bpe(self):
        """Ids of the vocabulary follow its merges, so they are the ranks; special tokens are left out."""
        import tiktoken

        ranks = {token: i for i, token in enumerate(self.a_bytes) if token}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def pieces(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.piece_bpe)

    @cached_property
    def tables(self) -> dict[str, np.ndarray]:
        """Byte lengths, and the decimal ids of A and B with the sign that follows them inside, then at the end of a group."""

        def written(count: int, sign: str) -> list[bytes]:
            return [f"{i}{sign}".encode() for i in range(count)]

        a, b = self.a_bytes, self.b_bytes
        signs = [*written(len(a), ","), *written(len(b), ","), *written(len(a), "|"), *written(len(b), ";")]
        return {
            "a_length": np.array([len(x) for x in a], dtype=np.int64),
            "b_length": np.array([len(x) for x in b], dtype=np.int64),
            "written": np.array(signs, dtype=object),
            "b_from": np.int64(len(a)),
            "last_from": np.int64(len(a) + len(b)),
        }

    def encode(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both, or None where there are none or the tokens do not spell a space and the text."""
        if not text:
            return None
        try:
            plain = text.decode()
        except UnicodeDecodeError:
            return None
        whole = b" " + text
        a, b = self.bpe.encode_ordinary(f" {plain}"), self.pieces.encode(plain)
        a_ids = np.array(a, dtype=np.int64)
        # Merges only join neighbouring bytes, so A's tokens spell the bytes of the text if they have as many.
        if self.tables["a_length"][a_ids].sum() != len(whole) or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
            return None
        return a_ids, np.array(b, dtype=np.int64)


@dataclass
class Alignment:
    """Tokens of a text: where both sides end (as numbers of tokens), and the linked tokens by position."""

    a_cuts: np.ndarray
    b_cuts: np.ndarray
    a_linked: np.ndarray
    b_linked: np.ndarray


def aligned(a_ends: np.ndarray, b_ends: np.ndarray) -> Alignment:
    """Cut both lists at the ends they share and link the tokens that overlap.

    `a_ends` and `b_ends` are ascending byte offsets with the same last one. Between
    two neighbouring ends of either side there is one token of A and one of B, and
    every overlap of two tokens is one such stretch, so a group of m and n tokens
    has m + n - 1 links.
    """
    a_index = dict(zip(a_ends.tolist(), range(1, len(a_ends) + 1), strict=True))
    b_index = dict(zip(b_ends.tolist(), range(1, len(b_ends) + 1), strict=True))
    # A dictionary keeps its order, so what both hold comes ascending.
    shared = list(filter(a_index.__contains__, b_index))
    a_cuts = np.fromiter(map(a_index.__getitem__, shared), dtype=np.int64, count=len(shared))
    b_cuts = np.fromiter(map(b_index.__getitem__, shared), dtype=np.int64, count=len(shared))
    # A group's links begin with its first tokens and step on at every end, on both sides.
    ends = np.concatenate([a_ends, b_ends])
    ends.sort(kind="stable")
    ends = ends[np.diff(ends, prepend=-1) > 0]
    return Alignment(a_cuts, b_cuts, np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends))


def written_groups(a: np.ndarray, b: np.ndarray, found: Alignment, tables: dict[str, np.ndarray]) -> bytes:
    """The groups as `a1,a2|b1;a3|b2,b3`."""
    # A token's place is its number plus the tokens of the other side that stand before its group, or up to its end.
    before = np.concatenate([[0], found.b_cuts[:-1]])
    a_place = np.arange(len(a)) + np.repeat(before, np.diff(found.a_cuts, prepend=0))
    b_place = np.arange(len(b)) + np.repeat(found.a_cuts, np.diff(found.b_cuts, prepend=0))
    out = np.empty(len(a) + len(b), dtype=np.int64)
    out[a_place], out[b_place] = a, b + tables["b_from"]
    for last in (a_place[found.a_cuts - 1], b_place[found.b_cuts - 1]):
        out[last] += tables["last_from"]
    return b"".join(tables["written"][out].tolist())[:-1]


LINK_COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"


def linker(shared, groups: bool):
    """doc_id and LINK_COLUMNS (and the groups as text, if wanted) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers: Tokenizers = shared.value
        tables = tokenizers.tables

        def row(text: bytes | None) -> tuple:
            ids = tokenizers.encode(text)
            if ids is None:
                return (0, 0, 0, 0, "", [], [], "")
            a, b = ids
            found = aligned(np.cumsum(tables["a_length"][a]), np.cumsum(tables["b_length"][b]))
            spelled = written_groups(a, b, found, tables)
            pairs, times = np.unique(a[found.a_linked] * PAIR_BASE + b[found.b_linked], return_counts=True)
            digest = hashlib.sha256(spelled).hexdigest()
            sizes = (len(a), len(b), len(found.a_cuts), len(found.a_linked))
            return (*sizes, digest, pairs, times.astype(np.int32), spelled.decode() if groups else "")

        for batch in batches:
            texts = batch.column("text").to_pylist()
            # Copies of a text within a batch are aligned once.
            known = {text: row(text) for text in set(texts)}
            rows = [known[text] for text in texts]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
            kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "groups"]
            kept = len(names) if groups else len(names) - 1
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays[:kept]], names=["doc_id", *names[:kept]])

    return run


def link(docs: DataFrame, tokenizers: Tokenizers, doc_id: str = "doc_id", text: str = "text", groups: bool = False) -> DataFrame:
    """One row per document row: the sizes, the digest of its groups, and its distinct linked id pairs with their numbers.

    `groups` adds the groups as text. Null and empty texts, bytes that are no
    UTF-8, and texts that the tokens of a side do not spell byte by byte have no
    tokens: zeros, no pairs and the empty string. Repeated rows each give a row;
    other columns than the two named are not read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))
    extra = ", groups string" if groups else ""
    run = linker(share(spark, tokenizers), groups)
    return rows.mapInArrow(run, f"doc_id {id_type}, {LINK_COLUMNS}{extra}")


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, count, best): in how many rows a pair is linked, and whether that is the most of its A id.

    An A id has at most as many pairs as B has tokens, so the window sees bounded groups.
    """
    counts = staged(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").count(), "pair-counts")
    a_id = F.shiftright("pair", 32)
    most = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("most"))
    return counts.join(most, a_id == F.col("a")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def split_by_count(counts: DataFrame, limit: int) -> int:
    """The smallest power of two that at most `limit` pairs reach with their count."""
    sizes = counts.groupBy(F.floor(F.log2("count")).alias("power")).agg(F.count("*").alias("n")).collect()
    reached, least = 0, 1 << (max((r["power"] for r in sizes), default=0) + 1)
    for row in sorted(sizes, key=lambda r: -r["power"]):
        reached += row["n"]
        if reached > limit:
            break
        least = 1 << row["power"]
    return least


def align(
    docs: DataFrame,
    tokenizers: Tokenizers,
    doc_id: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT_PAIRS,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document row.

    The texts are encoded once; what they link is a written table. A pair's count
    is the number of rows that hold it linked. Counts of the most frequent pairs,
    at most `frequent`, are broadcast. All other pairs meet theirs by shuffle: each
    of them is in few rows, so none is a hot key. `link` says what rows without
    tokens give; their n_best and count_sum are 0. Without rows the result is empty.
    """
    linked = staged(
        link(docs, tokenizers, doc_id, text).withColumn("row", F.monotonically_increasing_id()), "links"
    )
    counts = staged(pair_counts(linked), "pairs")
    least = split_by_count(counts, frequent)
    often, seldom = counts.filter(F.col("count") >= least), counts.filter(F.col("count") < least)
    every = linked.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times")
    )
    met = every.join(F.broadcast(often), "pair")
    if least > 1 and not seldom.isEmpty():
        # `often` and `seldom` are parts of one written table, so together they know every pair.
        rare = every.join(F.broadcast(often.select("pair")), "pair", "left_anti")
        met = met.unionByName(rare.join(seldom.hint("merge"), "pair"))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    )
    own = linked.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return own.join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )
