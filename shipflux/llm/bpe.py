"""Byte-level BPE: encode and decode with the ranks of a public vocabulary file.

A text is cut by the pattern; the bytes of every distinct word are merged once, by a
rank map, and looked up afterwards. Decoding joins the binary pieces of the ids. Ids
are packed: four bytes each, little-endian.

The merges run in Arrow batches. As expressions (higher-order functions over literal
maps) they gave the same ids, but took more memory and time than README allows for.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux.llm.common import share, slices

# So many distinct words a task remembers; beyond it starts anew, so no word is ever left out.
DICTIONARY_WORDS = 400_000
# Longer words are merged where they stand.
REMEMBERED_CHARACTERS = 64


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file by rank. The file has a fixed size, so the driver reads it."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    return [ranks[i] for i in range(len(ranks))]


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of a word: itself, if it is a token, or what is left when no two neighbours have a rank.

    Neighbours of the lowest rank merge first, the leftmost of several. They wait in a
    heap, so a word of n bytes takes n log n steps; pairs whose parts have gone are passed over.
    """
    if word in ranks:
        return [ranks[word]]
    size = len(word)
    # By start: where the part ends, 0 if no part starts there; by end: where the part starts.
    ends, starts = [*range(1, size + 1), 0], list(range(-1, size))
    waiting = [(ranks[word[i : i + 2]], i, i + 2) for i in range(size - 1) if word[i : i + 2] in ranks]
    heapq.heapify(waiting)
    while waiting:
        _, at, end = heapq.heappop(waiting)
        middle = ends[at]
        if not 0 < middle < end or ends[middle] != end:
            continue
        ends[at], ends[middle], starts[end] = end, 0, at
        before, after = starts[at], ends[end]
        if at and (rank := ranks.get(word[before:end])) is not None:
            heapq.heappush(waiting, (rank, before, end))
        if after and (rank := ranks.get(word[at:after])) is not None:
            heapq.heappush(waiting, (rank, at, after))
    out, at = [], 0
    while at < size:
        out.append(ranks[word[at : ends[at]]])
        at = ends[at]
    return out


class Words(dict):
    """Packed ids by word; a word that is asked for the first time is merged."""

    def __init__(self, ranks: dict[bytes, int], limit: int):
        super().__init__()
        self.ranks, self.limit = ranks, limit

    def __missing__(self, word: str) -> bytes:
        ids = b"".join(i.to_bytes(4, "little") for i in merged(word.encode(), self.ranks))
        if self.limit and len(word) <= REMEMBERED_CHARACTERS:
            if len(self) >= self.limit:
                self.clear()
            self[word] = ids
        return ids


def joined(packed: pa.Array, tokens: list[bytes]) -> pa.Array:
    """The tokens' pieces of packed ids, joined; none for null."""
    piece = tokens.__getitem__
    return pa.array((b"".join(map(piece, memoryview(p.as_py() or b"").cast("I"))) for p in packed), pa.binary())


@dataclass(frozen=True)
class Codec:
    """One vocabulary: the pattern that cuts texts, and the tokens by rank, sent to all workers once."""

    pattern: str
    tokens: Broadcast

    def encode(self, text: Column, dictionary: int) -> Column:
        return self._ids(text, dictionary, "binary", lambda ids, tokens: ids)

    def round_trip(self, text: Column, dictionary: int) -> Column:
        """`ids`, the packed ids of a text, and `back`, the bytes they decode to, from one Python worker."""

        def pair(ids: pa.Array, tokens: list[bytes]) -> pa.Array:
            return pa.StructArray.from_arrays([ids, joined(ids, tokens)], ["ids", "back"])

        return self._ids(text, dictionary, "struct<ids: binary, back: binary>", pair)

    def _ids(self, text: Column, dictionary: int, kind: str, result: Callable[[pa.Array, list[bytes]], pa.Array]) -> Column:
        tokens = self.tokens
        # The tokenizer reads \s as Unicode's White_Space, which `regex` is told by name.
        pattern = self.pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")

        @F.arrow_udf(kind)
        def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            cut = regex.compile(pattern).findall
            words = Words({token: rank for rank, token in enumerate(tokens.value)}, dictionary)
            for texts in (part for batch in batches for part in slices(batch, batch)):
                ids = pa.array((b"".join(map(words.__getitem__, cut(t.as_py() or ""))) for t in texts), pa.binary())
                yield result(ids, tokens.value)

        return encoded(text)

    def decode(self, ids: Column) -> Column:
        """The bytes of packed ids: the tokens' pieces, joined; none for null."""
        tokens = self.tokens

        @F.arrow_udf("binary")
        def pieces(packed: pa.Array) -> pa.Array:
            return joined(packed, tokens.value)

        return pieces(ids)


def codec(spark: SparkSession, path: str, pattern: str) -> Codec:
    """The codec of a rank file that holds all 256 bytes."""
    return Codec(pattern, share(spark, read_ranks(path)))


def encode(
    docs: DataFrame, codec: Codec, text: str = "text", out: str = "ids", dictionary: int = DICTIONARY_WORDS
) -> DataFrame:
    """`docs` with the binary column `out`: the packed token ids of the whole text.

    A task merges a distinct word once and remembers up to `dictionary` words at a
    time; nothing is shuffled. Null and empty texts have no ids; repeated rows are
    encoded alike; other columns pass through, and `out` replaces one of its name.
    """
    return docs.withColumn(out, codec.encode(F.col(text), dictionary))


def digests(encoded: DataFrame, codec: Codec, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, n_tokens and the sha256 of the packed ids and of the decoded bytes."""
    return digested(encoded.select(F.col(doc_id), F.col(ids).alias("ids"), codec.decode(F.col(ids)).alias("back")))


def round_trip_digests(
    docs: DataFrame, codec: Codec, doc_id: str = "doc_id", text: str = "text", dictionary: int = DICTIONARY_WORDS
) -> DataFrame:
    """`digests` of the encoded texts; a task encodes and decodes in one Python worker, not in two at a time."""
    pairs = docs.select(F.col(doc_id), codec.round_trip(F.col(text), dictionary).alias("pair"))
    return digested(pairs.select(doc_id, "pair.ids", "pair.back"))


def digested(rows: DataFrame) -> DataFrame:
    doc_id, ids, back = rows.columns
    return rows.select(
        doc_id,
        (F.length(ids) / 4).cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(back, 256).alias("decoded_sha256"),
    )
