"""Substring dedup: passages that an earlier document has as well are cut out.

A count-min sketch of all windows tells which may occur in two documents. It
counts too high, never too low, so the exact grouping of the second pass only
needs the windows it flags and loses none.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipflux.llm.common import share
from shipflux.llm.text import run_hashes, space_words, word_hashes

WINDOW = 13
# The sketch: rows of 2^CELL_BITS cells that saturate at 2; what travels is one bit a cell.
ROWS = 2
CELL_BITS = 29
BLOCK_BITS = 20
# Windows a task sketches, flagged windows it compares, and words it hashes, at a time.
SKETCH_WINDOWS = 4_000_000
FLAGGED_WINDOWS = 1_000_000
CHUNK_WORDS = 500_000


def windows(texts: list[str | None], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """(hash, second hash, text, words): all windows of some texts, in order, by the number of their text."""
    words = [space_words(t) for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = word_hashes([w for one in words for w in one])
    first = run_hashes(flat, length)
    second = run_hashes(flat, length, seed=1) >> np.uint64(33)
    owner = np.repeat(np.arange(len(texts)), sizes)
    inside = owner[: len(first)] == owner[length - 1 :] if len(first) else np.empty(0, dtype=bool)
    return first[inside], second[inside], owner[: len(first)][inside], words


def text_hash(text: str) -> int:
    digest = hashlib.md5(text.encode(), usedforsecurity=False).digest()
    return int.from_bytes(digest[:8], "little", signed=True)


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str | None]]]:
    """The rows of a batch as (ids, texts) of about CHUNK_WORDS words, or one longer text."""
    ids, texts, held = [], [], 0
    for one, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
        value = text.as_py()
        ids.append(one.as_py())
        texts.append(value)
        held += len(value or "") // 6 + 1
        if held >= CHUNK_WORDS:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def cells(hashes: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of every window in a row of the sketch."""
    return (hashes >> np.uint64(row * 30)) & np.uint64((1 << bits) - 1)


def packed(cells: np.ndarray) -> bytes:
    """Ascending cells of a block as gaps of one byte; 255 stands for 255 and no cell."""
    gaps = np.diff(cells.astype(np.int64), prepend=-1)
    skips = (gaps - 1) // 255
    out = np.full(int(skips.sum()) + len(gaps), 255, dtype=np.uint8)
    out[np.cumsum(skips + 1) - 1] = (gaps - 1) % 255
    return out.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    steps = np.frombuffer(data, dtype=np.uint8).astype(np.int64)
    ends = steps != 255
    return (np.cumsum(steps) + np.cumsum(ends))[ends] - 1


class Sketch:
    """A bit for every cell of every row; compressed while it travels."""

    def __init__(self, rows: list[np.ndarray]):
        self.rows = rows

    def __getstate__(self) -> list[bytes]:
        return [zlib.compress(row.tobytes(), 1) for row in self.rows]

    def __setstate__(self, state: list[bytes]) -> None:
        self.rows = [np.frombuffer(zlib.decompress(row), dtype=np.uint8) for row in state]


def sketched(length: int, bits: int, block_bits: int):
    """Cells of a task's windows by block: those seen, and those seen twice."""

    def of(hashes: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row in range(ROWS):
            found = np.sort(cells(hashes, row, bits))
            fresh = np.concatenate([[True], found[1:] != found[:-1]])
            once, twice = found[fresh], np.unique(found[~fresh])
            edges = np.arange((1 << (bits - block_bits)) + 1, dtype=np.uint64) << np.uint64(block_bits)
            cut1, cut2 = np.searchsorted(once, edges), np.searchsorted(twice, edges)
            rows: tuple[list, list, list] = ([], [], [])
            for block in np.flatnonzero(np.diff(cut1)):
                rows[0].append((row << 20) + int(block))
                for out, held, cut in ((rows[1], once, cut1), (rows[2], twice, cut2)):
                    out.append(packed(held[cut[block] : cut[block + 1]] - edges[block]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())],
                names=["block", "seen", "twice"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for _, texts in chunks(batch):
                held.append(windows(texts, length)[0])
                count += len(held[-1])
                if count >= SKETCH_WINDOWS:
                    yield from of(np.concatenate(held))
                    held, count = [], 0
        if count:
            yield from of(np.concatenate(held))

    return run


def merged(block_bits: int):
    """The sketches of a block, added up one after the other: a bit for every cell seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen, twice = None, None, None

        def done():
            bits = zlib.compress(np.packbits(twice, bitorder="little").tobytes(), 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([bits], pa.binary())], names=["block", "bits"]
            )

        for batch in batches:
            for block, once, more in zip(*(batch.column(c) for c in ("block", "seen", "twice")), strict=True):
                if block.as_py() != at:
                    if at is not None:
                        yield done()
                    at = block.as_py()
                    seen, twice = np.zeros(1 << block_bits, dtype=bool), np.zeros(1 << block_bits, dtype=bool)
                found = unpacked(once.as_py())
                twice[found[seen[found]]] = True
                seen[found] = True
                twice[unpacked(more.as_py())] = True
        if at is not None:
            yield done()

    return run


def repeated_cells(rows: DataFrame, length: int, bits: int) -> list[np.ndarray]:
    """For every row of the sketch, one bit a cell: at least two windows. 2^bits / 8 bytes each, at any input."""
    block_bits = min(BLOCK_BITS, bits)
    parts = rows.mapInArrow(sketched(length, bits, block_bits), "block int, seen binary, twice binary")
    # Cells are hashes: blocks are alike in size, and a task adds up one after the other.
    dealt = parts.repartition("block").sortWithinPartitions("block")
    out = [np.zeros((1 << bits) // 8, dtype=np.uint8) for _ in range(ROWS)]
    size = (1 << block_bits) // 8
    for batch in dealt.mapInArrow(merged(block_bits), "block int, bits binary").toArrow().to_batches():
        for block, data in zip(batch.column("block").to_pylist(), batch.column("bits"), strict=True):
            row, number = block >> 20, block & ((1 << 20) - 1)
            out[row][number * size : (number + 1) * size] = np.frombuffer(zlib.decompress(data.as_py()), dtype=np.uint8)
    return out


def ranks_of(ids: list) -> tuple[np.ndarray, list]:
    """The place of every id among the distinct ones in ascending order, and these."""
    names = sorted(set(ids))
    places = {name: i for i, name in enumerate(names)}
    return np.fromiter((places[i] for i in ids), np.int64, len(ids)), names


def decided(ids: list) -> np.ndarray:
    """Second hashes of rows that need no comparison any more: negative, and spread over the ids."""
    return np.fromiter((~(zlib.crc32(str(i).encode()) >> 1) for i in ids), np.int32, len(ids))


def flagged(sent, length: int, bits: int):
    """(h1, h2, doc_id): windows that the sketch has seen twice.

    Of the documents a task holds at a time, the smallest that has a window sends it to
    be compared with other tasks' documents; the window is a later one in all others,
    which say so with a negative h2. So a passage of many documents is a row a task, not a row
    a document. A text that a smaller id of the task has had is one such row with the hash of the text.
    """

    def of(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]], ids: list, kind: pa.DataType) -> pa.RecordBatch:
        first, second, owner = (np.concatenate(part) for part in zip(*held, strict=True))
        ranks, names = ranks_of(ids)
        rank = ranks[owner]
        order = np.lexsort((rank, second, first))
        first, second, rank = first[order], second[order], rank[order]
        new_window = np.ones(len(first), dtype=bool)
        new_window[1:] = (first[1:] != first[:-1]) | (second[1:] != second[:-1])
        fresh = new_window.copy()
        fresh[1:] |= rank[1:] != rank[:-1]
        mark = np.where(new_window, second.astype(np.int32), decided(names)[rank] if names else np.int32(0))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(first[fresh].view(np.int64)),
                pa.array(mark[fresh], pa.int32()),
                pa.array(names, kind).take(pa.array(rank[fresh])),
            ],
            names=["h1", "h2", "doc_id"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = sent.value.rows
        earlier: dict = {}
        held, held_ids, count, kind = [], [], 0, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for ids, texts in chunks(batch):
                copies, marks = [], []
                for i, text in enumerate(texts):
                    if text:
                        key = hashlib.md5(text.encode(), usedforsecurity=False).digest()
                        if key in earlier and earlier[key] < ids[i]:
                            copies.append(ids[i])
                            marks.append(text_hash(text))
                            texts[i] = None
                        else:
                            earlier[key] = ids[i]
                first, second, owner, _ = windows(texts, length)
                kept = np.ones(len(first), dtype=bool)
                for row in range(ROWS):
                    cell = cells(first, row, bits).astype(np.int64)
                    kept &= (sketch[row][cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
                held.append((first[kept], second[kept], owner[kept] + len(held_ids)))
                held_ids += ids
                count += int(kept.sum())
                if count >= FLAGGED_WINDOWS:
                    yield of(held, held_ids, kind)
                    held, held_ids, count = [], [], 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(marks, pa.int64()), pa.array(decided(copies), pa.int32()), pa.array(copies, kind)],
                    names=["h1", "h2", "doc_id"],
                )
        if held:
            yield of(held, held_ids, kind)

    return run


def cut_out(length: int):
    """doc_id, kept text, n_words, n_removed, kept_sha256 of documents with the hashes of their removed windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, texts in chunks(batch):
                first, _, owner, words = windows(texts, length)
                cut = np.searchsorted(owner, np.arange(len(texts) + 1))
                rows = []
                for i, one in enumerate(words):
                    gone = batch.column("gone")[at + i].values
                    left = one
                    if gone is not None and len(gone):
                        hashes, gone = first[cut[i] : cut[i + 1]].view(np.int64), gone.to_numpy()
                        whole = bool(texts[i]) and text_hash(texts[i]) in gone
                        starts = np.ones(len(hashes), dtype=bool) if whole else np.isin(hashes, gone)
                        edge = np.zeros(len(one) + 1, dtype=np.int64)
                        edge[: len(starts)] += starts
                        edge[length : length + len(starts)] -= starts
                        left = [w for w, n in zip(one, np.cumsum(edge[:-1]), strict=True) if not n]
                    kept = b" ".join(left)
                    rows.append((kept.decode(), len(one), len(one) - len(left), hashlib.sha256(kept).hexdigest()))
                at += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, batch.schema.field("doc_id").type),
                        pa.array([r[0] for r in rows], pa.string()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([r[2] for r in rows], pa.int64()),
                        pa.array([r[3] for r in rows], pa.string()),
                    ],
                    names=["doc_id", "kept", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = WINDOW, bits: int = CELL_BITS
) -> DataFrame:
    """doc_id, kept (the text left over), n_words, n_removed and kept_sha256 of every document row.

    A word goes if a window of `length` words covers it whose words also start in
    a document of smaller id. Windows are compared by 95 bits of hashes. Null and
    empty texts have no words. Rows of one id are one document to each other and
    are judged row by row; rows with a null id neither lose words nor make others
    lose any. Other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    named = rows.filter("doc_id IS NOT NULL")
    id_type = docs.schema[doc_id].dataType.simpleString()
    sent = share(docs.sparkSession, Sketch(repeated_cells(named, length, bits)))
    found = named.mapInArrow(flagged(sent, length, bits), f"h1 long, h2 int, doc_id {id_type}")
    # One shuffle by window; a task's documents have been compared before, so a window has at most a row for
    # every stretch of documents that a task holds at a time.
    first = F.min("doc_id").over(Window.partitionBy("h1", "h2"))
    later = found.withColumn("first", first).filter("h2 < 0 OR doc_id > first").select("doc_id", "h1")
    gone = later.groupBy("doc_id").agg(F.collect_set("h1").alias("gone"))
    joined = rows.join(gone, "doc_id", "left").select("doc_id", "text", "gone")
    return joined.mapInArrow(
        cut_out(length), f"doc_id {id_type}, kept string, n_words long, n_removed long, kept_sha256 string"
    )
