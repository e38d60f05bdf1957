"""Near duplicates: ProbMinHash signatures of weighted shingles, banding, exact verification, classes.

ProbMinHash: every shingle sends out points of a Poisson process whose rate is its
share of the text; a point falls into one register, which keeps the shingle of its
earliest point. Two registers agree with the probability Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import fresh, share, slices
from shipflux.llm.components import components
from shipflux.llm.text import mixed, plain_words, run_hashes, word_hashes
from shipflux.session import staged

SHINGLE = 5
THRESHOLD = 0.8
BANDS, BAND_ROWS = 32, 6
# Buckets up to this size are compared by pairs, larger ones by blocks of so many members and words.
SMALL_BUCKET = 8
BLOCK_MEMBERS, BLOCK_WORDS = 512, 500_000
# Numbers of a matrix that a comparison of blocks holds at a time, in a few copies.
CELL_NUMBERS = 1_000_000
# Texts whose registers are filled together.
CHUNK_TEXTS = 1_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending, with their counts; a shorter text is one shingle."""
    if not words:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    hashes = word_hashes(words)
    return np.unique(run_hashes(hashes, min(length, len(words))), return_counts=True)


def probability_jaccard(left: tuple, right: tuple) -> float:
    """Sum over common elements of 1 / sum of max(p'/p, q'/q) over all elements, for shares p and q."""
    every = np.union1d(left[0], right[0])
    p, q = np.zeros(len(every)), np.zeros(len(every))
    p[np.searchsorted(every, left[0])] = left[1] / left[1].sum()
    q[np.searchsorted(every, right[0])] = right[1] / right[1].sum()
    with np.errstate(divide="ignore"):
        ratio = np.where(q > 0, p / np.where(q > 0, q, 1), np.inf)
    order = np.argsort(-ratio, kind="stable")
    p, q, ratio = p[order], q[order], ratio[order]
    # Of elements with a larger p/q the first term is the larger one, of the others the second.
    above = np.concatenate([[0.0], np.cumsum(p)])
    below = np.concatenate([np.cumsum(q[::-1])[::-1], [0.0]])
    common = np.flatnonzero((p > 0) & (q > 0))
    cut = np.searchsorted(-ratio, -ratio[common], side="left")
    return float((1 / (above[cut] / p[common] + below[cut] / q[common])).sum()) if len(common) else 0.0


def uniform(elements: np.ndarray, turn: int, kind: int) -> np.ndarray:
    """Pseudo-random 64-bit numbers of an element's turn, the same in every text."""
    with np.errstate(over="ignore"):
        return mixed(elements + np.uint64(2 * turn + kind + 1) * _STEP)


def signatures(texts: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """One row of `size` registers per text (hashes, counts); texts without shingles have zeros.

    The k-th points of all shingles are drawn together. A shingle stops when its
    next point comes later than the latest register of its text (early termination).
    """
    owner = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])
    elements = np.concatenate([t[0] for t in texts]) if texts else np.empty(0, dtype=np.uint64)
    rates = np.concatenate([t[1] / max(1, t[1].sum()) for t in texts]) if texts else np.empty(0)
    times = np.full((len(texts), size), np.inf)
    holders = np.zeros((len(texts), size), dtype=np.uint64)
    flat_times, flat_holders = times.ravel(), holders.ravel()
    clock, turn = np.zeros(len(elements)), 0
    while len(elements):
        u = (uniform(elements, turn, 0) >> np.uint64(11)).astype(np.float64) + 0.5
        clock = clock - np.log(u / 2.0**53) / rates
        latest = times.max(axis=1)
        alive = clock < latest[owner]
        owner, elements, rates, clock = owner[alive], elements[alive], rates[alive], clock[alive]
        register = owner * size + (uniform(elements, turn, 1) % np.uint64(size)).astype(np.int64)
        better = np.flatnonzero(clock < flat_times[register])
        # Of several points for one register the earliest is written last.
        better = better[np.argsort(-clock[better], kind="stable")]
        flat_times[register[better]] = clock[better]
        flat_holders[register[better]] = elements[better]
        turn += 1
    return holders


def signed(bands: int, rows: int, length: int):
    """doc_id, content (hash of the words; null without words), number of words and band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, whole.column("text"))):
            for at in range(0, batch.num_rows, CHUNK_TEXTS):
                part = batch.slice(at, CHUNK_TEXTS)
                words = [plain_words(t.as_py()) for t in part.column("text")]
                content = [hashlib.md5(b" ".join(w), usedforsecurity=False).digest() if w else None for w in words]
                # Equal contents within the chunk are signed once.
                fresh = {c: i for i, c in enumerate(content) if c}
                holders = signatures([shingles(words[i], length) for i in fresh.values()], bands * rows)
                keys = np.zeros((len(fresh), bands), dtype=np.uint64)
                with np.errstate(over="ignore"):
                    for band in range(bands):
                        key = np.full(len(fresh), np.uint64(band + 1) * _STEP)
                        for row in range(rows):
                            key = mixed(key + holders[:, band * rows + row])
                        keys[:, band] = key
                number = {c: i for i, c in enumerate(fresh)}
                listed = [keys[number[c]].view(np.int64) if c else None for c in content]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(content, pa.binary()),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array(listed, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "content", "words", "bands"],
                )

    return run


def verified(length: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict = {}
            kept = []
            for left, right in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True):
                if len(known) > 500:
                    known.clear()
                for text in (left, right):
                    if text not in known:
                        known[text] = shingles(plain_words(text), length)
                kept.append(probability_jaccard(known[left], known[right]) >= threshold - 1e-12)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    length: int = SHINGLE,
    bands: int = BANDS,
    rows: int = BAND_ROWS,
) -> DataFrame:
    """doc_id, class_id and representative of every document row.

    Words are lower-cased runs of digits, ASCII letters and non-ASCII characters.
    Texts of the same words are one; its representative is the smallest id. Two
    representatives are linked if their probability Jaccard over counted shingles
    of `length` words is at least `threshold` (a shorter text is one shingle); a
    class is a component of links and named by its smallest id. Pairs at the
    threshold meet in a band with probability 1 - (1 - t^rows)^bands (0.9999).

    Null and empty texts, and texts without words, are in a class of their own;
    rows with a null id have a null class; repeated rows of one id are one document
    (with different texts, one that links what each of its texts is linked with).
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    share(docs.sparkSession, None)
    sketch = staged(
        texts.mapInArrow(signed(bands, rows, length), f"doc_id {id_type}, content binary, words long, bands array<long>"),
        "signatures",
    )
    named = sketch.filter("doc_id IS NOT NULL AND content IS NOT NULL")
    first = named.groupBy("content").agg(F.min(F.struct("doc_id", "words", "bands")).alias("m"))
    reps = staged(first.select("content", F.col("m.doc_id").alias("rep"), "m.words", "m.bands"), "reps")
    keyed = reps.select(F.col("rep").alias("id"), "words", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").count().filter("count > 1").select("key")
    members = keyed.join(shared.hint("merge"), "key").groupBy("key", "id").agg(F.max("words").alias("words"))
    buckets = staged(members, "buckets")
    # Only these texts are compared, in every later step.
    held = staged(texts.join(buckets.select(F.col("id").alias("doc_id")).distinct().hint("merge"), "doc_id", "left_semi"), "texts")

    def links(pairs: DataFrame) -> DataFrame:
        """The pairs whose texts are similar enough."""
        pairs = staged(pairs.select("a", "b").distinct(), "pairs")
        sides = pairs.join(held.toDF("a", "left").hint("merge"), "a").join(held.toDF("b", "right").hint("merge"), "b")
        return staged(sides.mapInArrow(verified(length, threshold), f"a {id_type}, b {id_type}"), "links")

    everyone = buckets.withColumn("root", F.col("id"))
    found = links(stars(everyone, 0).union(stars(everyone, 1)))
    roots = components(found)
    still_open = sized(open_buckets(buckets, roots))
    rest = links(strays(still_open.filter(F.col("members") <= SMALL_BUCKET)))
    cells = dealt(still_open.filter(F.col("members") > SMALL_BUCKET)).hint("merge")
    compared = cells.join(held.toDF("id", "text").hint("merge"), "id").groupBy("key", "x", "y")
    rest = staged(rest.union(compared.applyInArrow(between_blocks(length, threshold), f"a {id_type}, b {id_type}")), "links")
    if not rest.isEmpty():
        roots = components(found.union(rest))
    # Ids that stand for several contents are one vertex, so the smallest root holds for all of them.
    by_rep = reps.select("content", F.col("rep").alias("representative"))
    by_rep = by_rep.join(roots.withColumnRenamed("id", "representative"), "representative", "left")
    by_rep = by_rep.select("content", "representative", F.coalesce("root", "representative").alias("class_id"))
    return sketch.select("doc_id", "content").join(by_rep.hint("merge"), "content", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("representative", "doc_id")).alias("representative"),
    )


def open_buckets(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """(key, id, words, root): members of the buckets that still hold ids of different components."""
    labelled = buckets.join(roots, "id", "left").select("key", "id", "words", F.coalesce("root", "id").alias("root"))
    labelled = staged(labelled, "members")
    mixed_keys = labelled.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    return staged(labelled.join(mixed_keys.select("key").hint("merge"), "key"), "open")


def sized(members: DataFrame) -> DataFrame:
    """`members` with their bucket's number of members and its largest component, each with its sums."""
    by_root = members.groupBy("key", "root").agg(F.count("*").alias("count"), F.sum("words").alias("words"))
    sizes = by_root.groupBy("key").agg(
        F.max(F.struct("count", "words", "root")).alias("largest"),
        F.sum("count").alias("members"),
        F.sum("words").alias("all_words"),
    )
    return members.join(sizes.hint("merge"), "key")


def stars(members: DataFrame, turn: int) -> DataFrame:
    """One member of a bucket, another for every turn, with every other: as many pairs as rows."""
    pivots = members.groupBy("key").agg(
        F.min(F.struct(F.xxhash64(F.col("id"), F.lit(turn)).alias("order"), "id", "root")).alias("pivot")
    )
    pairs = members.join(pivots.hint("merge"), "key").filter("root <> pivot.root")
    return pairs.select(F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b"))


def strays(members: DataFrame) -> DataFrame:
    """Members outside their bucket's largest component, with all members of other components.

    Members of one component need no further comparison, so this is the whole rest. It is for
    small buckets, which have less than SMALL_BUCKET pairs a member.
    """
    outside = members.filter("root <> largest.root").select("key", F.col("id").alias("one"), F.col("root").alias("one_root"))
    pairs = outside.join(members.select("key", "id", "root").hint("merge"), "key").filter("one_root <> root")
    return pairs.select(F.least("one", "id").alias("a"), F.greatest("one", "id").alias("b"))


def dealt(members: DataFrame, block: int = BLOCK_MEMBERS, words: int = BLOCK_WORDS) -> DataFrame:
    """(key, x, y, left, id, root): buckets cut into blocks, a row for every two blocks that meet.

    Members outside the largest component are dealt by hash into the first blocks, the others
    into the blocks after these. Every outside block x meets every later block y, and itself where
    it meets the next one, so no pair of different components is left out, and a bucket
    of n members sends n rows for each block it has outside instead of its pairs. `left` marks x.
    """
    largest = F.col("largest")

    def blocks(count, size):
        """So many blocks of about `block` members and `words` words; one at least."""
        return F.greatest(F.ceil(count / block), F.ceil(size / words), F.lit(1)).cast("int")

    outside = blocks(F.col("members") - largest["count"], F.col("all_words") - largest["words"])
    inside = blocks(largest["count"], largest["words"])
    is_out = F.col("root") != largest["root"]
    order = F.xxhash64("id", F.lit(BLOCK_MEMBERS))
    own = F.when(is_out, F.pmod(order, "outside")).otherwise(F.col("outside") + F.pmod(order, "inside")).cast("int")
    placed = members.select("key", "id", "root", "largest", outside.alias("outside"), inside.alias("inside"))
    placed = placed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("outside") + F.col("inside") - 1)))
    met = placed.filter((F.col("own") != F.col("other")) & (F.least("own", "other") < F.col("outside")))
    x, y = F.least("own", "other"), F.greatest("own", "other")
    return met.select("key", x.alias("x"), y.alias("y"), (F.col("own") == x).alias("left"), "id", "root")


def ceilings(texts: list[tuple[np.ndarray, np.ndarray]], left: np.ndarray) -> np.ndarray:
    """A number that no probability Jaccard of the texts `left` with the other texts exceeds.

    With P and Q the shares that two texts have in their common elements it is
    1 / (1/P + 1/Q - 1), since p q / (q + p (1 - Q)) is an upper bound of a common
    element's term, is concave, and grows with the pair (p, q) in proportion. If a text
    repeats nothing, nor the other, this is their similarity. A text's number with itself means nothing.
    """
    owner = np.repeat(np.arange(len(texts)), [len(t[0]) for t in texts])
    share = np.concatenate([t[1] / max(1, t[1].sum()) for t in texts])
    _, column, count = np.unique(np.concatenate([t[0] for t in texts]), return_inverse=True, return_counts=True)
    # Elements of one text are in no common part.
    kept = count[column] > 1
    number = np.cumsum(count > 1) - 1
    owner, share, column = owner[kept], share[kept].astype(np.float32), number[column[kept]]
    order = np.argsort(column, kind="stable")
    owner, share, column = owner[order], share[order], column[order]
    place = np.full(len(texts), -1)
    place[left] = np.arange(len(left))
    mine, theirs = (np.zeros((len(left), len(texts)), dtype=np.float32) for _ in range(2))
    width = int(column[-1]) + 1 if len(column) else 0
    step = max(1, min(width, CELL_NUMBERS // len(texts)))
    for start in range(0, width, step):
        part = slice(*np.searchsorted(column, [start, start + step]))
        shares = np.zeros((len(texts), step), dtype=np.float32)
        shares[owner[part], column[part] - start] = share[part]
        held = (shares > 0).astype(np.float32)
        mine += shares[left] @ held.T
        theirs += held[left] @ shares.T
    with np.errstate(divide="ignore"):
        return 1 / (1 / mine + 1 / theirs - 1)


def between_blocks(length: int, threshold: float):
    """The links that join components of two blocks: exact, and not more than there are components."""

    def run(cell: pa.Table) -> pa.Table:
        ids, roots = cell.column("id").to_pylist(), cell.column("root").to_pylist()
        texts = [shingles(plain_words(t.as_py()), length) for t in cell.column("text")]
        is_left = np.array(cell.column("left").to_pylist())
        names = {root: i for i, root in enumerate(dict.fromkeys(roots))}
        root = np.array([names[r] for r in roots])
        parent = list(range(len(names)))

        def end(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found = []
        left = np.flatnonzero(is_left)
        if len(left):
            most = ceilings(texts, left)
            asked = (most >= threshold - 1e-4) & (root[left][:, None] != root[None, :])
            if cell.column("y")[0].as_py() != cell.column("x")[0].as_py() + 1:
                asked &= ~is_left[None, :]
            one, two = np.nonzero(asked)
            for at in np.argsort(-most[one, two], kind="stable"):
                i, j = int(left[one[at]]), int(two[at])
                a, b = end(root[i]), end(root[j])
                if a != b and probability_jaccard(texts[i], texts[j]) >= threshold - 1e-12:
                    parent[a] = b
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
        kind = cell.schema.field("id").type
        return pa.table({"a": pa.array([a for a, _ in found], kind), "b": pa.array([b for _, b in found], kind)})

    return run


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without the documents that have a smaller id in their class; every column stays.

    Rows of one id share their fate; rows with a null id are kept.
    """
    gone = fresh(docs, "gone")
    later = classes(docs, doc_id, text, threshold).filter("doc_id <> class_id").select(F.col("doc_id").alias(gone))
    return docs.join(later.distinct().hint("merge"), F.col(doc_id) == F.col(gone), "left_anti")
