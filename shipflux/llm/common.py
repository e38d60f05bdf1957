"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux.session import staged


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; every query reads one first, so workers know this package before they run."""
    tell_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tell_workers(spark: SparkSession) -> None:
    """The workers of a local master read this package where the driver does.

    On a cluster it is installed, or sent along with --py-files.
    """
    context = spark.sparkContext
    if context.master.startswith("local"):
        root = str(Path(__file__).resolve().parents[2])
        paths = context.environment.get("PYTHONPATH", "").split(":")
        if root not in paths:
            context.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def share(spark: SparkSession, value: Any):
    """Broadcast a value of bounded size to functions that run in Python workers."""
    tell_workers(spark)
    return spark.sparkContext.broadcast(value)


# A worker handles so many bytes of text at a time, or one longer text; Arrow batches are cut by rows only.
SLICE_BYTES = 4 << 20


def slices(rows: pa.RecordBatch | pa.Array, texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Any]:
    """`rows` in order, in parts whose `texts` have at most `limit` bytes, or of one longer text; nothing of no rows."""
    begin = held = 0
    for at, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + (size or 0) > limit:
            yield rows.slice(begin, at - begin)
            begin, held = at, 0
        held += size or 0
    if begin < len(texts):
        yield rows.slice(begin)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` worked out once, inside a row expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` is called so."""
    while name in {c.lower() for c in df.columns}:
        name = f"{name}_"
    return name


def learnable(doc_id: Column) -> Column:
    """True for the rows whose labels may be learnt; the others are held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2


def labelled_sample(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, limit: int
) -> DataFrame:
    """(doc_id, text, label): at most `limit` labelled rows that may be learnt, as a written table.

    The rows with the smallest hashes of their id are taken. Their ids are bounded,
    so they are broadcast and no text is shuffled to find them. Labels other than 0
    and 1 are left out; of several labels of one id the smallest counts.
    """
    usable = (
        labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & learnable(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return staged(rows.join(F.broadcast(chosen), "doc_id"), "labelled")
