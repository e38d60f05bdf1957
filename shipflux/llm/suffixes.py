"""Benchmark decontamination with suffix arrays of the training texts.

Every task sorts the word suffixes of its documents and binary-searches every
suffix of the benchmark in them. The benchmark is the stated query set: it goes
to all tasks, in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import fresh, share, slices
from shipflux.llm.text import plain_words

WINDOW = 13
# A suffix can only matter if it begins with this many words of some item.
PREFIX = 3
# Words of benchmark items that one pass over the documents searches for.
BLOCK_WORDS = 2_000_000
# A shard is closed when it has so many words (or holds one longer document).
SHARD_WORDS = 2_000_000


@dataclass
class Probe:
    """A block of items, ready for the search: vocabulary, suffixes and windows as numbers."""

    window: int
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    items: list[str] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)

    def add(self, item: str, words: list[bytes]) -> None:
        ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
        self.items.append(item)
        self.words.append(np.array(ids, dtype=np.int64))

    def sealed(self) -> Probe:
        """The suffixes of all items, distinct by their first `window` words."""
        self.prefix = min([PREFIX, *(len(w) for w in self.words)])
        rows, owners, lengths = [], [], []
        for number, ids in enumerate(self.words):
            padded = np.concatenate([ids, np.zeros(self.window, dtype=np.int64)])
            for at in range(len(ids)):
                rows.append(padded[at : at + self.window])
                owners.append((number, at))
                # What must match: a whole window, or all of an item shorter than one.
                full = len(ids) if len(ids) < self.window else self.window
                lengths.append(full if at + full <= len(ids) else 0)
        self.suffixes = np.array(rows, dtype=np.int64).reshape(-1, self.window)
        self.owners, self.lengths = owners, np.array(lengths, dtype=np.int64)
        self.starts = np.unique(self.keys(self.suffixes))
        return self

    def keys(self, rows: np.ndarray) -> np.ndarray:
        """The first words of suffixes as one number, equal for equal words."""
        key = np.zeros(len(rows), dtype=np.uint64)
        for i in range(self.prefix):
            key = key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i].astype(np.uint64)
        return key


def packed(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as fixed-length byte strings that sort as the rows do."""
    wide = np.ascontiguousarray(rows.astype(">u4"))
    return wide.view(f"S{wide.shape[1] * 4}").ravel()


def same_from(left: np.ndarray, at: int, right: np.ndarray, start: int) -> int:
    """How many words from `at` in one text equal those from `start` in the other; unknown words equal none."""
    size = min(len(left) - at, len(right) - start)
    a, b = left[at : at + size], right[start : start + size]
    differ = np.flatnonzero((a != b) | (a == 0))
    return int(differ[0]) if len(differ) else size


class Shard:
    """The suffix array of a few documents, restricted to suffixes that begin as some item does."""

    def __init__(self, probe: Probe, texts: list[np.ndarray]):
        self.probe, self.texts = probe, texts
        gap = np.zeros(probe.window, dtype=np.int64)
        parts = [part for text in texts for part in (text, gap)]
        self.words = np.concatenate([*parts, gap]) if parts else gap
        self.begins = np.cumsum([0, *(len(t) + probe.window for t in texts)])
        count = len(self.words) - probe.window
        key = np.zeros(count, dtype=np.uint64)
        for i in range(probe.prefix):
            key = key * np.uint64(0x9E3779B97F4A7C15) + self.words[i : i + count].astype(np.uint64)
        if len(probe.starts):
            near = np.searchsorted(probe.starts, key).clip(max=len(probe.starts) - 1)
            kept = np.flatnonzero((probe.starts[near] == key) & (self.words[:count] > 0))
        else:
            kept = np.empty(0, dtype=np.int64)
        rows = packed(self.words[kept[:, None] + np.arange(probe.window)]) if len(kept) else np.empty(0, "S4")
        order = np.argsort(rows, kind="stable")
        self.rows, self.positions = rows[order], kept[order]

    def search(self) -> Iterator[tuple[int, int, int, int]]:
        """(text, position, item, suffix): every place where a window of an item occurs."""
        if not len(self.rows):
            return
        probe = self.probe
        for length in np.unique(probe.lengths[probe.lengths > 0]):
            chosen = np.flatnonzero(probe.lengths == length)
            low = probe.suffixes[chosen].copy()
            low[:, length:] = 0
            high = probe.suffixes[chosen].copy()
            high[:, length:] = 2**32 - 1
            first = np.searchsorted(self.rows, packed(low), side="left")
            last = np.searchsorted(self.rows, packed(high), side="right")
            for which, begin, end in zip(chosen, first, last, strict=True):
                for position in self.positions[begin:end]:
                    text = int(np.searchsorted(self.begins, position, side="right")) - 1
                    item, at = probe.owners[which]
                    yield text, int(position - self.begins[text]), item, at


def judge(probe: Probe, texts: list[np.ndarray]) -> list[dict]:
    """Hit words, items and the longest match of every text."""
    found = [{"hits": np.zeros(len(t), dtype=bool), "items": set(), "longest": (0, None, 0, 0)} for t in texts]
    for text, position, item, at in Shard(probe, texts).search():
        one = found[text]
        size = len(probe.words[item])
        one["hits"][position : position + min(size, probe.window)] = True
        one["items"].add(probe.items[item])
        length = same_from(texts[text], position, probe.words[item], at)
        one["longest"] = max(one["longest"], (length, probe.items[item], position, at), key=lambda m: m[0])
    return found


def runs_of(flags: np.ndarray) -> tuple[list[int], list[int]]:
    """Begins and ends of the runs of true flags."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2].tolist(), edge[1::2].tolist()


FOUND = (
    "n_words long, n_hit long, n_items long, items array<string>, items_sha256 string,"
    " longest_match long, longest_item string, longest_at long, contaminated boolean"
)


def finish(words: int, begins: list[int], ends: list[int], items: list[str], longest: tuple) -> tuple:
    hit = sum(ends) - sum(begins)
    items = sorted(items)
    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
    return (words, hit, len(items), items, digest, *longest, hit > 0 and 20 * hit >= words)


def merged_runs(runs: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    begins, ends = [], []
    for begin, end in sorted(runs):
        if ends and begin <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            begins.append(begin)
            ends.append(end)
    return begins, ends


def blocks(benchmark: DataFrame, item: str, text: str, window: int, limit: int) -> Iterator[Probe]:
    """The items in blocks of at most `limit` words or one item; they stream through the driver."""
    probe, held = Probe(window), 0
    for row in benchmark.select(F.col(item).cast("string"), text).toLocalIterator():
        words = plain_words(row[1])
        if not words:
            continue
        if held and held + len(words) > limit:
            yield probe.sealed()
            probe, held = Probe(window), 0
        probe.add(row[0], words)
        held += len(words)
    yield probe.sealed()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document row: doc_id and the columns of FOUND.

    A document word is hit if an occurrence of `window` consecutive item words
    covers it; an item of fewer words counts as a whole. Null and empty texts have
    no words and are clean; empty benchmarks find nothing; repeated document rows
    are judged one by one; repeated items of one id count once. Items are compared
    by their id as text. Other columns are not read.

    A benchmark of several blocks takes one pass per block; each pass carries the
    findings of the ones before, so no row is shuffled. The last pass finishes them
    in the same Python worker, and no pass but those before it hands texts on.
    """
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    carried = (
        "doc_id {}, text string, n_words long, begins array<int>, ends array<int>, items array<string>,"
        " longest_match long, longest_item string, longest_at long"
    ).format(id_type)
    rows = rows.select(
        "*",
        F.lit(0).cast("long").alias("n_words"),
        *(F.array().cast("array<int>").alias(name) for name in ("begins", "ends")),
        F.array().cast("array<string>").alias("items"),
        F.lit(0).cast("long").alias("longest_match"),
        F.lit(None).cast("string").alias("longest_item"),
        F.lit(0).cast("long").alias("longest_at"),
    )
    *passes, last = [share(spark, probe) for probe in blocks(benchmark, item_id, item_text, window, block_words)]
    for sent in passes:
        rows = rows.mapInArrow(searching(sent), carried)
    return rows.mapInArrow(searching(last, finished), f"doc_id {id_type}, {FOUND}")


def searching(sent, then: Callable[[pa.RecordBatch], pa.RecordBatch] = lambda batch: batch):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = sent.value
        number = probe.vocabulary.get
        for batch in (part for whole in batches for part in slices(whole, whole.column("text"))):
            texts = batch.column("text")
            counts, begins, ends, items, longest = [], [], [], [], []
            shard: list[np.ndarray] = []

            def close():
                for one, at in zip(judge(probe, shard), range(len(counts) - len(shard), len(counts)), strict=True):
                    b, e = runs_of(one["hits"])
                    old = zip(batch.column("begins")[at].as_py(), batch.column("ends")[at].as_py(), strict=True)
                    b, e = merged_runs([*old, *zip(b, e, strict=True)])
                    begins.append(b)
                    ends.append(e)
                    items.append(sorted(one["items"] | set(batch.column("items")[at].as_py())))
                    before = tuple(
                        batch.column(c)[at].as_py() for c in ("longest_match", "longest_item", "longest_at")
                    )
                    longest.append(max(one["longest"][:3], before, key=lambda m: m[0]))
                shard.clear()

            held = 0
            for value in texts:
                words = plain_words(value.as_py())
                counts.append(len(words))
                shard.append(np.fromiter((number(w, 0) for w in words), dtype=np.int64, count=len(words)))
                held += len(words)
                if held >= SHARD_WORDS:
                    close()
                    held = 0
            close()
            found = pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    texts,
                    pa.array(counts, pa.int64()),
                    pa.array(begins, pa.list_(pa.int32())),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array([m[0] for m in longest], pa.int64()),
                    pa.array([m[1] for m in longest], pa.string()),
                    pa.array([m[2] for m in longest], pa.int64()),
                ],
                names=batch.schema.names,
            )
            yield then(found)

    return run


def finished(batch: pa.RecordBatch) -> pa.RecordBatch:
    names = [c.split()[0] for c in FOUND.split(", ")]
    kinds = [
        pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(),
        pa.int64(), pa.string(), pa.int64(), pa.bool_(),
    ]
    columns = [
        batch.column(c).to_pylist()
        for c in ("n_words", "begins", "ends", "items", "longest_match", "longest_item", "longest_at")
    ]
    rows = [finish(*row[:4], row[4:]) for row in zip(*columns, strict=True)]
    arrays = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` without the contaminated ones, all columns kept. Rows of one id share one fate.

    Rows with a null id have no name to be removed by and are kept.
    """
    bad = fresh(docs, "bad")
    found = contamination(docs, benchmark, doc_id, text).filter("contaminated").select(F.col("doc_id").alias(bad))
    return docs.join(found.distinct(), F.col(doc_id) == F.col(bad), "left_anti")
