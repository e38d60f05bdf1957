"""Quality classifier: Naive Bayes log-count ratios scale n-gram indicators, a linear hinge-loss model weighs them.

The n-grams are words, and runs of up to three token shapes. A shape says how a
token is written (capitals, digits, its symbols) or that it repeats the one before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.llm.common import labelled_sample, learnable, share, slices
from shipflux.llm.tokens import TOKEN, term_counts

# Labelled rows the model is fitted on, chosen by a hash of their id.
MAX_ROWS = 16_000
# N-grams the model keeps: those whose ratio is farthest from chance.
MAX_TERMS = 30_000
MIN_COUNT = 5
# Of the fitting rows, those kept apart to turn margins into probabilities.
CALIBRATED = 0.2
SHAPES = 3


def shape(token: str) -> str:
    if token.isalpha():
        return "A" if token.isupper() and len(token) > 1 else "T" if token[0].isupper() else "a"
    if token.isdigit():
        return "0"
    return token[:3] if not any(c.isalnum() for c in token) else "m"


def ngrams(text: str) -> set[str]:
    """Words, marked by a space, and runs of one to three shapes."""
    tokens = TOKEN.findall(text)
    shapes, known = [], {}
    before = None
    for token in tokens:
        if token == before:
            shapes.append("=")
            continue
        before = token
        if token not in known:
            known[token] = shape(token)
        shapes.append(known[token])
    found = {f" {t.lower()}" for t in known}
    for size in range(1, SHAPES + 1):
        found.update("\t".join(run) for run in set(zip(*(shapes[i:] for i in range(size)), strict=False)))
    return found


@dataclass
class Model:
    """score = sigmoid(slope * (weights of the n-grams present + bias) + offset)"""

    weights: dict[str, float]
    bias: float
    slope: float
    offset: float

    def margin(self, text: str | None) -> float:
        weights = self.weights
        return self.bias + math.fsum(weights[g] for g in ngrams(text or "") & weights.keys())

    def score(self, text: str | None) -> float:
        return probability(self.slope * self.margin(text) + self.offset)


def probability(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))


def log_count_ratios(counts: DataFrame, limit: int, minimum: int) -> dict[str, float]:
    """r = log of the smoothed shares of a term in the two classes, for the `limit` farthest from 0."""
    counts = counts.filter(F.col("n0") + F.col("n1") >= minimum)
    totals = counts.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1")).first()
    if totals["t0"] is None:
        return {}
    ratio = F.log((F.col("n1") + 1) / F.lit(totals["t1"] + 1.0)) - F.log((F.col("n0") + 1) / F.lit(totals["t0"] + 1.0))
    ranked = counts.select("term", ratio.alias("r"), (F.abs(ratio) * F.sqrt(F.col("n0") + F.col("n1"))).alias("pull"))
    return dict(ranked.orderBy(F.desc("pull"), "term").limit(limit).select("term", "r").toPandas().itertuples(index=False))


def dual_descent(
    rows: list[np.ndarray], values: np.ndarray, labels: np.ndarray, size: int, cost: np.ndarray, rounds: int = 15
) -> np.ndarray:
    """Minimise |w|^2 / 2 + sum of cost * hinge loss by dual coordinate descent; the last weight is the bias."""
    w, alpha = np.zeros(size + 1), np.zeros(len(rows))
    norms = np.array([float(np.square(values[r]).sum()) + 1 for r in rows])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r = rows[i]
            gradient = labels[i] * (values[r] @ w[r] + w[-1]) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * labels[i]
            if step:
                alpha[i] = new
                w[r] += step * values[r]
                w[-1] += step
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


def logistic_fit(margins: np.ndarray, labels: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of the lightly penalised log loss with smoothed targets, by Newton steps that must gain."""
    ones, zeros = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = float(margins.std()) or 1.0
    x = np.stack([margins / scale, np.ones_like(margins)], axis=1)
    ridge = np.diag([1e-2, 1e-6])

    def loss(beta):
        z = x @ beta
        return float((np.logaddexp(0, z) - target * z).sum() + beta @ ridge @ beta / 2)

    beta = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
        gradient = x.T @ (p - target) + ridge @ beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(2), gradient)
        while np.abs(step).max() > 1e-9 and loss(beta - step) > loss(beta):
            step = step / 2
        beta = beta - step
        if np.abs(step).max() <= 1e-9:
            break
    return float(max(beta[0], 0.0)) / scale, float(beta[1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = MAX_ROWS,
    max_terms: int = MAX_TERMS,
) -> Model:
    """A model from the labels that may be learnt.

    It sees at most `max_rows` of them, the ones with the smallest hashes of their
    id. Rows with a null or other label than 0 and 1 teach nothing. Without rows of
    both classes the model has no weights and scores the share of label 1 (one half
    without rows).
    """
    rows = labelled_sample(docs, labels, doc_id, text, label, max_rows)
    ratios = log_count_ratios(term_counts(rows, "text", "label", ngrams), max_terms, MIN_COUNT)
    names = {term: i for i, term in enumerate(ratios)}
    sent = share(docs.sparkSession, names)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value
        for batch in batches:
            found = [sorted(number[g] for g in ngrams(t.as_py() or "") & number.keys()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(found, pa.list_(pa.int32()))], names=["label", "terms"]
            )

    held = (
        rows.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(max_rows)
        .select("text", "label")
        .mapInArrow(index, "label int, terms array<int>")
        .toArrow()
    )
    target = np.array(held.column("label").to_pylist(), dtype=np.int64)
    if len(set(target.tolist())) < 2:
        ones = float(target.mean()) if len(target) else 0.5
        return Model({}, 0.0, 0.0, math.log((ones + 1e-6) / (1 - ones + 1e-6)))
    features = [np.array(t, dtype=np.int64) for t in held.column("terms").to_pylist()]
    apart = int(len(target) * CALIBRATED)
    values = np.array(list(ratios.values()))
    train, y = features[apart:], target[apart:]
    # Both classes pull equally, and no row more than its n-grams allow.
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    w = dual_descent(train, values, 2 * y - 1, len(values), 0.02 * weight)
    weights = w[:-1] * values
    margins = np.array([weights[f].sum() + w[-1] for f in features])
    slope, offset = logistic_fit(margins[:apart] if apart else margins, target[:apart] if apart else target)
    kept = {term: float(weights[i]) for term, i in names.items() if weights[i]}
    return Model(kept, float(w[-1]), slope, offset)


def score(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, from the whole text and nothing else.

    Null and empty texts have no n-grams and score what the bias says; repeated
    rows score alike; a null id is not held out.
    """
    sent = share(docs.sparkSession, model)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = sent.value.score
        for batch in batches:
            scores = pa.array([judge(t.as_py()) for t in batch.column("text")], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], names=["doc_id", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = rows.mapInArrow(run, f"doc_id {id_type}, score double")
    return scored.select(
        "doc_id",
        F.coalesce(~learnable(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """`docs` without the rows that score below the threshold; every column stays, in its place.

    The verdict depends on the text alone, so rows are filtered where they lie.
    """
    sent = share(docs.sparkSession, model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = sent.value.score
        for batch in (part for whole in batches for part in slices(whole, whole.column(at))):
            yield batch.filter(pa.array([judge(t.as_py()) >= threshold for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
