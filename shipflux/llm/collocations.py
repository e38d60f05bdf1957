"""Phrase collocations: frequent n-grams by Misra-Gries summaries, then exact counts and scores.

First every n-gram is a 64-bit hash. Tasks add up their n-grams per hash partition
and hand these partial summaries on; a partition merges them into one Misra-Gries
summary whose capacity exceeds its mass divided by the threshold, so no n-gram that
reaches the threshold is lost. The number of partitions grows with the corpus, the
size of a summary does not. The second pass counts the surviving n-grams exactly,
by their words. Words and pairs are summarized first: only runs of surviving pairs
can hold a longer phrase that is frequent enough.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipflux.llm.common import share
from shipflux.llm.text import mixed, word_hashes
from shipflux.session import staged

THRESHOLD = 100
LONGEST = 5
BEST = 2_000
# Counters of one summary, and n-grams a task adds up before it hands them on.
CAPACITY = 500_000
HELD = 6_000_000
HELD_PHRASES = 500_000
# Surviving n-grams of one hash partition of the exact counts.
PART_PHRASES = 20_000
# Bytes of text that are cut into words together; a longer text is taken alone.
CHUNK_BYTES = 4_000_000
# Bits of the table of survivors: so many for each, and at most 2^30 (128 MB). A fuller table lets more through.
BITS_EACH, MOST_BITS = 64, 30
# A side whose rows have at most so many bytes together is broadcast; a larger one is repeated for so many salts.
SMALL_BYTES = 16 << 20
SALTS = 16

UNKNOWN_LANG = "und"
# Stands for the end of a piece; no byte of UTF-8.
_END = b"\xff"
_PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_FACTOR = np.uint64(0xD1342543DE82EF95)


def _byte_table() -> bytes:
    """Piece ends become _END, a tab a space, A-Z a-z."""
    table = bytearray(range(256)).lower()
    for b in _PIECE_ENDS:
        table[b] = _END[0]
    table[ord("\t")] = ord(" ")
    return bytes(table)


_TABLE = _byte_table()


@dataclass
class Words:
    """The words of some texts of one language in order; a row of `ids` is -1 where a piece ends."""

    vocabulary: list[bytes]
    ids: np.ndarray
    hashes: np.ndarray

    def __len__(self) -> int:
        return int((self.ids >= 0).sum())


def words_of(texts: list[bytes], lang: str) -> Words:
    """The words of all texts, hashed together with their language."""
    spaced = _END.join(texts).translate(_TABLE).replace(_END, b" " + _END + b" ")
    coded = pa.array(spaced.split(), pa.binary()).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    vocabulary = coded.dictionary.to_pylist()
    if not vocabulary:
        return Words([], ids, np.empty(0, dtype=np.uint64))
    hashes = mixed(word_hashes(vocabulary) ^ word_hashes([lang.encode()])[0])
    hashes = hashes[ids]
    if _END in vocabulary:
        ids[ids == vocabulary.index(_END)] = -1
    return Words(vocabulary, ids, hashes)


def ngram_hashes(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the n-gram that begins at each word, and whether it ends inside the piece."""
    count = max(0, len(words.ids) - length + 1)
    total, whole = np.zeros(count, dtype=np.uint64), np.ones(count, dtype=bool)
    with np.errstate(over="ignore"):
        for i in range(length):
            total = total * _FACTOR + words.hashes[i : i + count]
            whole &= words.ids[i : i + count] >= 0
        return mixed(total + np.uint64(length)), whole


class Survivors:
    """A table of bits, one set for each surviving hash: never misses one, and may take others for one."""

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - bits)
        self.cells = np.zeros(1 << (bits - 3), dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        at = hashes >> self.shift
        np.bitwise_or.at(self.cells, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))

    def hold(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def in_runs(words: Words, pairs: Survivors, length: int, whole: np.ndarray) -> np.ndarray:
    """Where an n-gram is whole and all pairs of neighbours in it survive."""
    hashes, fits = ngram_hashes(words, 2)
    kept = fits & pairs.hold(hashes)
    held = whole.copy()
    for i in range(length - 1):
        held &= kept[i : i + len(held)]
    return held


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of a task by language, in lists of bounded size."""
    held: dict[str, tuple[list[bytes], int]] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            texts, size = held.get(lang, ([], 0))
            texts.append(text.as_py())
            held[lang] = texts, size + len(texts[-1])
            if held[lang][1] >= CHUNK_BYTES:
                yield lang, held.pop(lang)[0]
            elif len(held) > 50 or sum(s for _, s in held.values()) >= 4 * CHUNK_BYTES:
                yield from ((k, v[0]) for k, v in held.items())
                held = {}
    yield from ((k, v[0]) for k, v in held.items())


def added_up(hashes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with their summed counts."""
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    every, times = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, times = every[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.empty(0, dtype=int)
    return every[first], np.add.reduceat(times, first) if len(first) else times


def partial_summaries(lengths: list[int], parts: int, shared_pairs):
    """(part, hashes, counts): a task's n-grams of these lengths, added up, one row per hash partition."""

    def rows(hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        """Ascending hashes are also ordered by partition, as that is their upper bits' share of all."""
        part = ((hashes >> np.uint64(33)) * np.uint64(parts) >> np.uint64(31)).astype(np.int64)
        edges = np.searchsorted(part, np.arange(parts + 1))
        used = np.flatnonzero(np.diff(edges))
        slices = [slice(edges[p], edges[p + 1]) for p in used]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()),
                pa.array([hashes[s].tobytes() for s in slices], pa.binary()),
                pa.array([counts[s].astype(np.uint32).tobytes() for s in slices], pa.binary()),
            ],
            names=["part", "hashes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared_pairs.value if shared_pairs else None
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        held = 0
        for lang, texts in chunks(batches):
            words = words_of(texts, lang)
            for length in lengths:
                values, whole = ngram_hashes(words, length)
                if pairs is not None:
                    whole = in_runs(words, pairs, length, whole)
                found, times = np.unique(values[whole], return_counts=True)
                hashes.append(found)
                counts.append(times)
                held += len(found)
            if held >= HELD:
                yield rows(*added_up(hashes, counts))
                hashes, counts, held = [], [], 0
        yield rows(*added_up(hashes, counts))

    return run


class MisraGries:
    """A summary of at most `capacity` counters; a count is short by at most `error`, which stays below `threshold`.

    As long as the mass is less than capacity times threshold that follows from the
    capacity. A summary that gets more mass, by hashes that share a partition with
    very frequent ones, keeps more counters rather than a larger error.
    """

    def __init__(self, capacity: int, threshold: int):
        self.capacity, self.threshold, self.error = capacity, threshold, 0
        self.hashes, self.counts = added_up([], [])

    def merge(self, hashes: list[np.ndarray], counts: list[np.ndarray]) -> None:
        """Add other counters; if there are too many, lower all by the largest that has no place."""
        self.hashes, self.counts = added_up([self.hashes, *hashes], [self.counts, *counts])
        extra = len(self.counts) - self.capacity
        if extra > 0:
            lower = int(np.partition(self.counts, extra - 1)[extra - 1])
            if self.error + lower >= self.threshold:
                return
            kept = self.counts > lower
            self.hashes, self.counts = self.hashes[kept], self.counts[kept] - lower
            self.error += lower

    def frequent(self) -> np.ndarray:
        """All hashes that may have reached the threshold."""
        return self.hashes[self.counts + self.error >= self.threshold]


def merged_summaries(capacity: int, threshold: int):
    """The hashes that may be frequent, of rows (part, hashes, counts) that come ordered by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def survivors(summary: MisraGries) -> pa.RecordBatch:
            found = summary.frequent().view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["hash"])

        part, summary = None, MisraGries(capacity, threshold)
        hashes: list[np.ndarray] = []
        counts: list[np.ndarray] = []

        def drain():
            summary.merge(hashes, counts)
            hashes.clear()
            counts.clear()

        for batch in batches:
            for at, blob, times in zip(*(batch.column(i) for i in range(3)), strict=True):
                if at.as_py() != part:
                    drain()
                    if part is not None:
                        yield survivors(summary)
                    part, summary = at.as_py(), MisraGries(capacity, threshold)
                hashes.append(np.frombuffer(blob.as_py(), dtype=np.uint64))
                counts.append(np.frombuffer(times.as_py(), dtype=np.uint32).astype(np.int64))
                if sum(map(len, hashes)) >= capacity:
                    drain()
        drain()
        yield survivors(summary)

    return run


def possibly_frequent(
    rows: DataFrame, lengths: list[int], mass: int, threshold: int, capacity: int, pairs: Survivors | None = None
) -> DataFrame:
    """(hash): every n-gram of these lengths that occurs `threshold` times, and few others, as a written table.

    `mass` is at least the number of n-grams. There are so many hash partitions that
    the capacity is twice an even share of the mass over the threshold.
    """
    spark = rows.sparkSession
    parts = max(1, -(-2 * mass // (threshold * capacity)))
    partial = rows.mapInArrow(
        partial_summaries(lengths, parts, share(spark, pairs) if pairs else None), "part int, hashes binary, counts binary"
    )
    dealt = partial.repartition(parts, "part").sortWithinPartitions("part")
    return staged(dealt.mapInArrow(merged_summaries(capacity, threshold), "hash long"), "survivors")


def survivor_table(found: list[DataFrame]) -> Survivors:
    """The survivors' bits as one table of bounded size; only the parts that hold any reach the driver."""
    count = sum(f.count() for f in found)
    bits = min(MOST_BITS, max(10, (BITS_EACH * count).bit_length()))
    table = Survivors(bits)
    for rows in found:
        # Spark's bitmaps number their bits from 1 and have 32,768 of them.
        cell = F.shiftrightunsigned("hash", 64 - bits) + 1
        parts = rows.groupBy(F.bitmap_bucket_number(cell).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("held")
        )
        for row in parts.toLocalIterator():
            held = np.frombuffer(row["held"], dtype=np.uint8)
            at = (row["bucket"] - 1) * len(held)
            table.cells[at : at + len(held)] |= held[: len(table.cells) - at]
    return table


def chunk_phrases(words: Words, lengths: list[int], table: Survivors, pairs: Survivors) -> Iterator[tuple[bytes, int, int]]:
    """(phrase, words, count) of the surviving n-grams of a chunk; hashes only tell which may be equal."""
    for length in lengths:
        values, whole = ngram_hashes(words, length)
        if length > 2:
            whole = in_runs(words, pairs, length, whole)
        places = np.flatnonzero(whole & table.hold(values))
        _, first, owner = np.unique(values[places], return_index=True, return_inverse=True)
        # Equal hashes of other words than the first one's are counted on their own.
        same = np.ones(len(places), dtype=bool)
        for i in range(length):
            same &= words.ids[places + i] == words.ids[places[first][owner] + i]
        shown = np.concatenate([places[first], places[~same]])
        counts = [*np.bincount(owner[same], minlength=len(first)).tolist(), *[1] * int((~same).sum())]
        ids = words.ids[shown[:, None] + np.arange(length)].tolist()
        for row, count in zip(ids, counts, strict=True):
            yield b" ".join([words.vocabulary[i] for i in row]), length, count


# A task's partial counts of one hash partition; a null phrase counts all words.
PARTIAL = "part int, lang array<string>, phrase array<binary>, words array<int>, count array<long>"


def partial_counts(lengths: list[int], parts: int, shared_table, shared_pairs):
    """A task's occurrences of surviving n-grams, added up: one row of PARTIAL for each hash partition."""

    def rows(held: dict[tuple[str, bytes | None, int], int]) -> pa.RecordBatch:
        by_part: dict[int, list[tuple]] = {}
        for key, count in held.items():
            by_part.setdefault(zlib.crc32(key[1] or b"") * parts >> 32, []).append((*key, count))
        columns = [[list(c) for c in zip(*entries, strict=True)] for entries in by_part.values()]
        kinds = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
        lists = [pa.array([c[i] for c in columns], pa.list_(kind)) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(
            [pa.array(by_part.keys(), pa.int32()), *lists], names=["part", "lang", "phrase", "words", "count"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, pairs = shared_table.value, shared_pairs.value
        held: dict[tuple[str, bytes | None, int], int] = {}
        for lang, texts in chunks(batches):
            words = words_of(texts, lang)
            held[lang, None, 0] = held.get((lang, None, 0), 0) + len(words)
            for phrase, size, count in chunk_phrases(words, lengths, table, pairs):
                key = lang, phrase, size
                held[key] = held.get(key, 0) + count
            if len(held) >= HELD_PHRASES:
                yield rows(held)
                held = {}
        yield rows(held)

    return run


def exact_counts(threshold: int):
    """(lang, phrase, words, f) of what is frequent, and the numbers of words, of PARTIAL rows ordered by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sums = None, {}

        def frequent() -> pa.RecordBatch:
            kept = [(*key, f) for key, f in sums.items() if f >= threshold or key[1] is None]
            names, kinds = ["lang", "phrase", "words", "f"], [pa.string(), pa.binary(), pa.int32(), pa.int64()]
            columns = zip(*kept, strict=True) if kept else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for at in range(batch.num_rows):
                number, *columns = (c[at].as_py() for c in batch.columns)
                if number != part:
                    yield frequent()
                    part, sums = number, {}
                for *key, count in zip(*columns, strict=True):
                    entry = tuple(key)
                    sums[entry] = sums.get(entry, 0) + count
        yield frequent()

    return run


def phrase_counts(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    capacity: int = CAPACITY,
) -> DataFrame:
    """(lang, phrase, words, f): all phrases of 1 to `longest` words that occur `threshold` times in their language.

    The row with a null phrase and no words holds the number of all words. A-Z are
    lower-cased; texts are cut at `.,;:!?` and at line ends of any kind, and the
    pieces at spaces and tabs; phrases do not cross pieces, and their occurrences
    may overlap. Null texts are empty, a null language is `und`, repeated rows
    count again, other columns are not read. Without words there are no phrases.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text"),
    )
    # Two words of one text have a byte between them, so this bounds the number of words.
    words = rows.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    words = words // 2 + 1
    short = possibly_frequent(rows, [1, 2][:longest], 2 * words, threshold, capacity)
    pairs = survivor_table([short])
    longer = list(range(3, longest + 1))
    found = [short]
    if longer:
        found.append(possibly_frequent(rows, longer, len(longer) * words, threshold, capacity, pairs))
    table = survivor_table(found)
    lengths = list(range(1, longest + 1))
    parts = max(1, -(-sum(f.count() for f in found) // PART_PHRASES))
    partial = rows.mapInArrow(partial_counts(lengths, parts, share(spark, table), share(spark, pairs)), PARTIAL)
    dealt = partial.repartition(parts, "part").sortWithinPartitions("part")
    counted = dealt.mapInArrow(exact_counts(threshold), "lang string, phrase binary, words int, f long")
    return staged(counted.withColumn("phrase", F.col("phrase").cast("string")), "phrases")


def part(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def small(df: DataFrame, text: str) -> bool:
    """Whether a staged side may be broadcast, by the bytes of all its rows."""
    return (df.agg(F.sum(F.octet_length(text) + 40)).first()[0] or 0) <= SMALL_BYTES


def spread_join(rows: DataFrame, side: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Join with a staged side of unique keys that any number of rows may share.

    A small side is broadcast. Of a larger one every row is repeated for SALTS salts
    and `rows` are dealt over these by a hash of their column `phrase`.
    """
    if small(side, text):
        return rows.join(F.broadcast(side), keys)
    salted = side.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "salt"]).drop("salt")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of every phrase of two words or more, by its weakest cut.

    Decimals of 38 digits hold the products of counts up to 10^16.
    """
    totals = staged(counts.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n")), "totals")
    known = counts.filter(F.col("phrase").isNotNull())
    listed = F.split("phrase", " ")
    cuts = known.filter("words > 1").select(
        "lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    )
    cuts = cuts.withColumns({"left": part(listed, 1, F.col("k")), "right": part(listed, F.col("k") + 1, F.col("words"))})
    # Single words can be part of very many phrases; longer parts are part of few.
    single = staged(known.filter("words = 1"), "single-words")
    several = known.filter("words > 1")

    def with_count(rows: DataFrame, side: str, name: str) -> DataFrame:
        """Add the count of the part in column `side`; every part of a frequent phrase is frequent."""
        alone = F.col("k") == 1 if side == "left" else F.col("k") == F.col("words") - 1

        def named(counted: DataFrame) -> DataFrame:
            return counted.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))

        spread = spread_join(rows.filter(alone), named(single), ["lang", side], side)
        return spread.unionByName(rows.filter(~alone).join(named(several), ["lang", side]))

    both = spread_join(with_count(with_count(cuts, "left", "l"), "right", "r"), totals, ["lang"], "lang")

    def exact(column: str) -> Column:
        return F.col(column).cast("decimal(16,0)")

    above = exact("a") * exact("n") * F.lit(1000).cast("decimal(4,0)")
    both = both.withColumns({"above": above, "below": exact("l") * exact("r")}).withColumn("score", F.expr("above div below"))
    weakest = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    # n and a belong to the phrase, so grouping by them too changes nothing.
    return both.groupBy("lang", "phrase", "words", "a", "n").agg(weakest).select(
        "lang", "phrase", "words", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )


def covered(candidates: DataFrame) -> DataFrame:
    """(lang, phrase): those that lie in a longer candidate that occurs as often.

    A phrase occurs at least as often as any longer one around it, so what holds for
    a longer one holds for one with a single word more: only those are looked at.
    """
    listed = F.split("phrase", " ")
    inner = F.explode(F.array(part(listed, 1, F.col("words") - 1), part(listed, 2, F.col("words"))))
    longer = candidates.filter("words > 2").select("lang", inner.alias("phrase"), F.col("a").alias("around"))
    most = longer.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    return candidates.join(most, ["lang", "phrase"]).filter("around >= a").select("lang", "phrase")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    best: int = BEST,
    capacity: int = CAPACITY,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's `best` phrases of 2 to `longest` words.

    a, l and r are the counts of the phrase and of the two parts of its weakest cut
    (the smallest floor(1000 a n / (l r)), the earliest of equal ones), n all words
    of the language. Phrases inside a longer one that is as frequent are dropped.
    Ties of score go to the larger a, then to the smaller phrase by bytes.
    `phrase_counts` says what nulls, empty texts and repeated rows give.
    """
    found = staged(scored(phrase_counts(docs, text, lang, threshold, longest, capacity)), "scored")
    kept = found.join(covered(found), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= best)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
