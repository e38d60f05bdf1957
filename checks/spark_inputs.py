"""The derived inputs as Spark tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from shipflux.session import discard, prepare_session, work_folder

# Tables written during this session, by application, folder and name.
_stored: dict[tuple[str, str, str], str] = {}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input as a plan over the given tables."""
    prepare_session(spark)
    parts = [f"{item} AS ({inputs.SQL[item]})" for item in inputs.needed(name)]
    sql = f"WITH {', '.join(parts)} SELECT * FROM {name}"
    return spark.sql(re.sub(r"\{(\w+)\}", rf"parquet.`{sf_dir}/\1.parquet`", sql))


def stored(spark: SparkSession, sf_dir: str, name: str, build, beside: tuple[str, ...] = ()) -> DataFrame:
    """A table, written once per session and read back.

    Like the tables between jobs: the written copy has a known size, so the planner
    can decide on broadcasts from file statistics, and lineage ends there. What was
    staged `beside` it is not needed any longer.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        path = work_folder(spark, name)
        built = build()
        built.write.parquet(path)
        if beside:
            discard(built, *beside)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived dimension-sized input as a stored table."""
    def build() -> DataFrame:
        df = derive(spark, sf_dir, name)
        if name == "ships":
            df = df.withColumn("mmsi", F.array("mmsi_text")).drop("mmsi_text")
        return df

    return stored(spark, sf_dir, name, build)


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position reports: a projection of the largest given table, never stored."""
    return derive(spark, sf_dir, "ais")
