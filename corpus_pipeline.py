"""The corpus pipeline: stages over `documents`, each working on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux.llm import bpe, near, quality, secrets, suffixes
from shipflux.llm.common import table
from shipflux.llm.queries import VOCABULARY
from shipflux.session import staged


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates the document of smallest id stays."""
    return near.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold passages of the benchmark go."""
    return suffixes.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, and n_chars follows."""
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return secrets.redact(docs).withColumn("n_chars", F.coalesce(size, F.col("n_chars")))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    codec = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(docs, codec)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good),
    ("near_dedup", distinct),
    ("decontaminate", decontaminated),
    ("redact", redacted),
    ("encode", encoded),
]

# Trained models and merges have no SQL; tests compare with brute-force versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with a written table between two of them."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
