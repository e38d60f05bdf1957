"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "shipflux", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; anything can be overridden by `conf`."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.compression.codec": "zstd",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Files up to this size are broadcast unasked. Every broadcast passes through the driver, and rows of a few bytes in a file
# are ten times as many there; a larger side is only broadcast where its rows are counted first.
UNASKED_BROADCAST = 2 * 1024 * 1024


# Adaptive execution joins shuffled partitions up to this size. A report row of some 90 bytes there takes ten times as many
# in a task that sorts and groups it, so partitions of the usual 64 MB spill once the input is large enough to fill them.
SHUFFLED_PARTITION = 16 * 1024 * 1024


# Partitions that rows are dealt to before adaptive execution joins them again: rows of an input of several GB then still
# come to some megabytes a task, and sorting and grouping them needs no disk.
DEALT_PARTITIONS = 1000


def lowered(spark: SparkSession, name: str, most: int) -> None:
    """Set a size to `most` bytes, unless it is lower or, below 0, off."""
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)i?b?\s*", spark.conf.get(name).lower()).groups()
    if int(number) * 1024 ** " kmgtp".index(unit or " ") > most:
        spark.conf.set(name, str(most))


def lower_broadcast_limit(spark: SparkSession, name: str = "spark.sql.autoBroadcastJoinThreshold") -> None:
    """Set the limit to UNASKED_BROADCAST, unless it is lower or broadcasts are off."""
    lowered(spark, name, UNASKED_BROADCAST)


def prepare_session(spark: SparkSession) -> SparkSession:
    """Set what results and speed depend on, in a session someone else has built."""
    # Positions are stamped in UTC, so dates are only right when the session is too.
    # HotSpot interprets methods above 8000 bytes of bytecode. The stage that computes
    # all emissions exceeds that as one method; below the limit Spark splits it.
    # A row of a few bytes on disk takes some hundred in memory, so tasks over 128 MB of a file would spill.
    # What a query has shuffled is removed when it ends, not when the driver happens to collect garbage: a job of
    # several writes needs the disk of its largest one, not of all of them.
    # A busy ship is split over tasks even if its rows have to be shuffled again for their sums.
    # Rows that lie by ship already meet what is known by ship and voyage there, without another shuffle.
    wanted = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.files.maxPartitionBytes": "32m",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    for key, value in wanted.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    lower_broadcast_limit(spark)
    lowered(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", SHUFFLED_PARTITION)
    dealt = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(dealt, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < DEALT_PARTITIONS:
        spark.conf.set(dealt, str(DEALT_PARTITIONS))
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below `spark.checkpoint.dir`.

    A machine-local folder is only used when the master is local, because the
    executors of a cluster could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="shipflux-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def shares(df: DataFrame, names: Sequence[str], rounds: int) -> list[DataFrame]:
    """`df` in parts by a hash of these columns: all rows of one value are in one part."""
    share = F.pmod(F.xxhash64(*names), F.lit(rounds))
    return [df.filter(share == number) for number in range(rounds)] if rounds > 1 else [df]


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a written table in the work folder: computed once, with known size and no lineage."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame, *purposes: str) -> None:
    """Remove the tables `staged` wrote for `df` under these purposes; neither can be read any more."""
    spark = df.sparkSession
    folder = re.compile(rf".*/(?:{'|'.join(map(re.escape, purposes))})-[0-9a-f]{{32}}(?=/)")
    for path in {found[0] for file in df.inputFiles() if (found := folder.match(file))}:
        target = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(path))
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
