"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The index holds the labelled examples. Its blocks are runs of neighbouring
examples; a block stores the largest weight of every term, so the sum of
query weight times block maximum bounds every cosine inside. Blocks are visited
from the highest bound down, until none can beat the k-th best found.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import labelled_sample, learnable, share
from shipflux.llm.quality import logistic_fit, probability
from shipflux.llm.tokens import WORD, term_counts

# Labelled rows that become examples, chosen by a hash of their id.
MAX_EXAMPLES = 20_000
# Terms of the vectors: those the two classes use most differently.
MAX_TERMS = 4_096
# Least squared deviation (chi-square) of a term's class counts from chance.
MIN_SURPRISE = 30.0
BLOCK = 128
NEIGHBOURS = 15
CALIBRATED = 0.2
# Votes the base rate has beside the neighbours.
PRIOR_VOTES = 0.5


# Besides whole words, beginnings of this many letters are terms: insults are inflected.
BEGINNINGS = (4, 5)


def term_frequencies(text: str | None) -> Counter:
    """Words, and beginnings of longer words marked by a hyphen, with their counts."""
    counts = Counter(WORD.findall(text.lower())) if text else Counter()
    for word, n in list(counts.items()):
        for size in BEGINNINGS:
            if len(word) > size:
                counts[word[:size] + "-"] += n
    return counts


@dataclass
class Index:
    """Distinct example vectors in blocks; equal vectors are one example with several labels."""

    idf: dict[str, tuple[int, float]]
    base: float
    ids: list[int]
    ones: np.ndarray
    total: np.ndarray
    terms: list[np.ndarray]
    weights: list[np.ndarray]

    def sealed(self) -> Index:
        blocks = (len(self.ids) + BLOCK - 1) // BLOCK
        self.block_max = np.zeros((len(self.idf), blocks), dtype=np.float64)
        lists: list[list] = [[] for _ in self.idf]
        for at, (terms, weights) in enumerate(zip(self.terms, self.weights, strict=True)):
            for term, weight in zip(terms, weights, strict=True):
                lists[term].append((at, weight))
                self.block_max[term, at // BLOCK] = max(self.block_max[term, at // BLOCK], weight)
        self.postings = [
            (np.array([p[0] for p in one], dtype=np.int64), np.array([p[1] for p in one])) for one in lists
        ]
        self.slices = [np.searchsorted(p[0], np.arange(blocks + 1) * BLOCK) for p in self.postings]
        self.slope, self.offset = 1.0, 0.0
        self.seen: dict = {}
        return self

    def vector(self, text: str | None) -> tuple[tuple[int, ...], np.ndarray]:
        """Terms and unit-length weights (1 + log tf) * idf of a whole text."""
        idf = self.idf
        counts = term_frequencies(text)
        entries = sorted((idf[w][0], (1 + math.log(counts[w])) * idf[w][1]) for w in counts.keys() & idf.keys())
        weights = np.array([e[1] for e in entries])
        norm = math.sqrt(float(weights @ weights)) if len(weights) else 1.0
        return tuple(e[0] for e in entries), weights / norm

    def nearest(self, terms: tuple[int, ...], weights: np.ndarray, k: int = NEIGHBOURS) -> list[tuple[float, int]]:
        """The k examples of highest cosine above 0 as (cosine, example), ties to the earlier example."""
        if not terms or not self.ids:
            return []
        bounds = weights @ self.block_max[list(terms)]
        best: list[tuple[float, int]] = []
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or (len(best) == k and bounds[block] < best[-1][0] - 1e-12):
                break
            cosines = np.zeros(BLOCK)
            for term, weight in zip(terms, weights, strict=True):
                cut = slice(*self.slices[term][block : block + 2])
                cosines[self.postings[term][0][cut] - block * BLOCK] += weight * self.postings[term][1][cut]
            near = np.flatnonzero(cosines > 0)
            found = [(float(round(cosines[i], 12)), int(block) * BLOCK + int(i)) for i in near]
            best = sorted(best + found, key=lambda m: (-m[0], m[1]))[:k]
        return best

    def vote(self, neighbours: list[tuple[float, int]]) -> float:
        """Share of label 1, each example's labels weighted by the inverse of its distance."""
        up, down = PRIOR_VOTES * self.base, PRIOR_VOTES * (1 - self.base)
        for cosine, at in neighbours:
            # Many copies of one text are one kind of evidence: their weight grows slowly.
            size = math.log1p(float(self.total[at])) / float(self.total[at])
            near = cosine * size / (0.1 + math.sqrt(max(0.0, 2 - 2 * cosine)))
            up += near * float(self.ones[at])
            down += near * float(self.total[at] - self.ones[at])
        return math.log(up / down)

    def judge(self, text: str | None) -> tuple[float, list[int]]:
        """Calibrated score, and the ids of the examples it rests on, nearest first."""
        terms, weights = self.vector(text)
        key = (terms, weights.tobytes())
        if key not in self.seen:
            if len(self.seen) > 50_000:
                self.seen.clear()
            near = self.nearest(terms, weights)
            self.seen[key] = (
                probability(self.slope * self.vote(near) + self.offset),
                [self.ids[at] for _, at in near],
            )
        return self.seen[key]


def telling_terms(counts: DataFrame, limit: int) -> list[str]:
    """The terms with the largest chi-square between occurrence and label."""
    counts = counts.filter(F.col("n0") + F.col("n1") >= 5)
    totals = counts.agg(F.max("n0").alias("m0"), F.max("n1").alias("m1"), F.sum("n0").alias("t0"), F.sum("n1").alias("t1")).first()
    if not totals["t0"] or not totals["t1"]:
        return []
    share = totals["t1"] / (totals["t0"] + totals["t1"])
    size = F.col("n0") + F.col("n1")
    surprise = F.pow(F.col("n1") - size * share, 2) / (size * (share * (1 - share)))
    ranked = counts.select("term", surprise.alias("surprise")).filter(F.col("surprise") >= MIN_SURPRISE)
    return [r["term"] for r in ranked.orderBy(F.desc("surprise"), "term").limit(limit).collect()]


def inverse_frequencies(docs: DataFrame, text: str, terms: list[str]) -> dict[str, tuple[int, float]]:
    """Number and idf of the chosen terms, from their document frequency in all texts."""
    chosen = frozenset(terms)
    sent = share(docs.sparkSession, chosen)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = Counter(), 0
        for batch in batches:
            for value in batch.column(0):
                held.update(sent.value & term_frequencies(value.as_py()).keys())
            rows += batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(["", *held], pa.string()), pa.array([rows, *held.values()], pa.int64())], names=["term", "n"]
        )

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "term string, n long")
    summed = dict(found.groupBy("term").agg(F.sum("n").alias("n")).toPandas().itertuples(index=False))
    rows = summed.pop("", 0)
    return {t: (i, math.log((1 + rows) / (1 + summed.get(t, 0))) + 1) for i, t in enumerate(sorted(chosen))}


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    max_examples: int = MAX_EXAMPLES,
    max_terms: int = MAX_TERMS,
) -> Index:
    """The index of labelled examples, from the labels that may be learnt.

    At most `max_examples` rows, the ones with the smallest hashes of their id, choose
    the terms and become examples or, a fifth of them, calibrate the votes. Terms are
    weighted by their frequency in all texts. Rows with a null or other label than 0 and 1
    teach nothing. Without rows of both classes every text gets the base rate.
    """
    rows = labelled_sample(docs, labels, doc_id, text, label, max_examples)
    idf = inverse_frequencies(docs, text, telling_terms(term_counts(rows, "text", "label", term_frequencies), max_terms))
    vectors = Index(idf, 0.5, [], np.zeros(0), np.zeros(0), [], []).sealed()
    sent = share(docs.sparkSession, vectors)

    def vectorised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sent.value.vector(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.string()),
                    batch.column("label"),
                    pa.array([m[0] for m in made], pa.list_(pa.int32())),
                    pa.array([m[1] for m in made], pa.list_(pa.float64())),
                ],
                names=["doc_id", "label", "terms", "weights"],
            )

    held = (
        rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(max_examples)
        .mapInArrow(vectorised, "doc_id string, label int, terms array<int>, weights array<double>")
        .toArrow()
        .to_pylist()
    )
    base = (sum(r["label"] for r in held) + 0.5) / (len(held) + 1)
    apart = int(len(held) * CALIBRATED)
    merged: dict = {}
    for r in held[apart:]:
        if r["terms"]:
            one = merged.setdefault((tuple(r["terms"]), tuple(r["weights"])), [r["doc_id"], 0, 0])
            one[1] += r["label"]
            one[2] += 1
    # Neighbours in this order share terms, which keeps the block bounds tight.
    order = sorted(merged.items(), key=lambda m: (m[0][0][int(np.argmax(m[0][1]))], m[0]))
    index = Index(
        idf,
        base,
        [m[1][0] for m in order],
        np.array([m[1][1] for m in order], dtype=np.float64),
        np.array([m[1][2] for m in order], dtype=np.float64),
        [np.array(m[0][0], dtype=np.int64) for m in order],
        [np.array(m[0][1]) for m in order],
    ).sealed()
    labels_apart = np.array([r["label"] for r in held[:apart]])
    if len(set(labels_apart.tolist())) == 2:
        votes = [index.vote(index.nearest(tuple(r["terms"]), np.array(r["weights"]))) for r in held[:apart]]
        index.slope, index.offset = logistic_fit(np.array(votes), labels_apart)
    return index


def score(
    docs: DataFrame, index: Index, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3
) -> DataFrame:
    """doc_id, held_out, score, predicted and evidence (ids of the nearest examples) of every row.

    Null and empty texts, and texts without a telling term, have no neighbours and
    get the calibrated base rate. Repeated rows score alike; a null id is not held out.
    """
    sent = share(docs.sparkSession, index)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [sent.value.judge(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([j[0] for j in judged], pa.float64()),
                    pa.array([j[1] for j in judged], pa.list_(pa.string())),
                ],
                names=["doc_id", "score", "evidence"],
            )

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {id_type}, score double, evidence array<string>")
    return scored.select(
        "doc_id",
        F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "evidence",
    )
