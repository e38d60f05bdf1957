"""Streaming ingest of CSV drops into append-only bronze tables, and the silver tables that follow these.

A run takes the files that arrived since the last one and stops. The checkpoint
remembers the files, so a restart neither skips nor repeats any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shipflux import schemas
from shipflux.operators.electrification import spaced_battery


def with_origin(rows: DataFrame, kind: str) -> DataFrame:
    """Source, file and time of ingest of every row."""
    return rows.withColumns(
        {
            "bi_source": F.lit(kind),
            "bi_filepath": F.col("_metadata.file_path"),
            "bi_ingested_timestamp": F.current_timestamp(),
        }
    )


def read_stream(spark: SparkSession, kind: str, path: str, multi_line: bool = False) -> DataFrame:
    """New files of a drop; rows with malformed fields are kept whole in `_rescue`."""
    rows = (
        spark.readStream.format("csv")
        .schema(schemas.with_rescue(schemas.DROPS[kind]))
        .option("sep", ";")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", schemas.RESCUE)
        .load(path)
    )
    return with_origin(rows, kind)


def run_once(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is available now to a Parquet table and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


# Which drops may hold line breaks inside fields, and which are typed on the way in.
MULTI_LINE = {"emission_variables"}
TYPING: dict[str, Callable[[DataFrame], DataFrame]] = {"vessel_battery_stream": spaced_battery}


def ingest(spark: SparkSession, kind: str, path: str, table: str, checkpoint: str) -> StreamingQuery:
    """One ingest run of a drop."""
    stream = read_stream(spark, kind, path, kind in MULTI_LINE)
    typing = TYPING.get(kind)
    return run_once(stream.transform(typing) if typing else stream, table, checkpoint)


# Buckets a followed table and its history are cut into by a hash of the key.
BUCKETS = 64
# Tasks that may share a bucket, by a hash of whole rows: a busy key is spread over them.
SPREAD = 8
BUCKET, DELIVERY = "key_bucket", "delivery"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def replace_partitions(rows: DataFrame, path: str, *partitions: str) -> None:
    """Replace exactly the partitions that `rows` hold, each by a few files."""
    by_partition = rows.repartition(*partitions, F.pmod(F.xxhash64(*rows.columns), F.lit(SPREAD)))
    by_partition = by_partition.sortWithinPartitions(*partitions)
    writer = by_partition.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def take_delivery(
    rows: DataFrame, label: str, silver: str, build: Callable[[DataFrame], DataFrame], keys: Sequence[str], buckets: int
) -> None:
    """Bring a silver table up to date with new rows; only the buckets of their keys are read and replaced.

    The rows are kept in a history beside the table, in a partition of their own for
    each bucket and `label`. A label that comes again replaces what it wrote, and the
    touched buckets are built from history alone, so a delivery that failed half-way
    is mended by being taken again.
    """
    spark, history = rows.sparkSession, f"{silver}_history"
    labelled = rows.withColumns({BUCKET: key_bucket(keys, buckets), DELIVERY: F.lit(label)})
    replace_partitions(labelled, history, BUCKET, DELIVERY)
    kept = spark.read.parquet(history)
    touched = kept.filter(F.col(DELIVERY) == label).select(BUCKET).distinct().collect()
    if touched:
        past = kept.filter(F.col(BUCKET).isin([row[BUCKET] for row in touched])).drop(BUCKET, DELIVERY)
        replace_partitions(build(past).withColumn(BUCKET, key_bucket(keys, buckets)), silver, BUCKET)


def follow(
    spark: SparkSession,
    bronze: str,
    silver: str,
    checkpoint: str,
    build: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Take what is new in a bronze table into the silver table that follows it, then stop.

    `prepare` types the new rows, before they are kept; `build` makes silver rows from
    all kept rows of whole keys, such as `scd1` or `scd2`, and hands the keys on.
    Rows that come late find their place, since all earlier rows of their key are at
    hand; rows that come twice add nothing `build` would not drop.
    """
    run = hashlib.md5(checkpoint.encode(), usedforsecurity=False).hexdigest()

    def take(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        take_delivery(rows, f"{run}-{number}", silver, build, keys, buckets)

    query = (
        spark.readStream.schema(spark.read.parquet(bronze).schema)
        .parquet(bronze)
        .writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def followed(spark: SparkSession, silver: str) -> DataFrame:
    """A followed table as it stands."""
    return spark.read.parquet(silver).drop(BUCKET)
