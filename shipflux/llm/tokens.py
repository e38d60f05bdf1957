"""Word tokens for the classifiers, and counts of them that are summed before they are shuffled."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"\w+|[^\w\s]+")
WORD = re.compile(r"[^\W\d_]+")
# A task hands its counts on when it holds so many terms.
HELD_TERMS = 500_000


def term_counts(rows: DataFrame, text: str, label: str, terms: Callable[[str], Iterable[str]]) -> DataFrame:
    """(term, n0, n1): in how many texts of label 0 and 1 a term occurs.

    Every task adds up its own rows, so a frequent term is one row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[Counter, Counter] = (Counter(), Counter())

        def flush():
            names = list(held[0].keys() | held[1].keys())
            out = pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([c[n] for n in names], pa.int64()) for c in held)],
                names=["term", "n0", "n1"],
            )
            for c in held:
                c.clear()
            return out

        for batch in batches:
            for value, kind in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held[kind].update(set(terms(value.as_py() or "")))
                if len(held[0]) + len(held[1]) >= HELD_TERMS:
                    yield flush()
        yield flush()

    counted = rows.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label")).mapInArrow(
        count, "term string, n0 long, n1 long"
    )
    return counted.groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
