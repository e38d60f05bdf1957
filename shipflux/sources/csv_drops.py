"""Batch reads of the hand-made CSV drops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux import schemas
from shipflux.functions.cleaning import DATE_PATTERN


def read_drop(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """All files of a drop, with their origin and the time of ingest."""
    rows = spark.read.csv(
        path, header=True, sep=";", schema=schemas.struct(schemas.DROPS[kind]), dateFormat=DATE_PATTERN
    )
    return rows.withColumns(
        {
            "bi_source": F.lit(kind),
            "bi_filepath": F.lit(path),
            "bi_ingested_timestamp": F.current_timestamp(),
        }
    )
