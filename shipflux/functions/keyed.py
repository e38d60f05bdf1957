"""One row per key, and joins whose small side is proven small."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast below this size; executors hold it once per JVM.
BROADCAST_BYTES = 64 * 1024 * 1024


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in a total order.

    `row_number() = 1` makes Spark cut each group to one row per map task before
    the shuffle (WindowGroupLimit), so a hot key never reaches one task whole.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def row_bytes(df: DataFrame) -> Column:
    """Bytes a row takes in a hash table: a word per column and what lies behind it."""
    total = F.lit(64)
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        size = F.lit(0)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(column)
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.NumericType):
            size = F.size(column) * 8
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            size = F.octet_length(F.to_json(column))
        total = total + 16 + F.coalesce(size, F.lit(0))
    return total


_measured: dict[tuple, int] = {}


def plan_state(df: DataFrame) -> tuple:
    """What a plan reads, besides its steps: a table that is written again has other files."""
    files = hashlib.sha256("\n".join(sorted(df.inputFiles())).encode()).hexdigest()
    return df.sparkSession.sparkContext.applicationId, df.semanticHash(), df.schema.json(), files


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows in memory, worked out once per plan and state of its files.

    File sizes say little about it: a column of few distinct names is almost free on
    disk. The measure is a distributed sum that returns one number.
    """
    key = plan_state(df)
    if key not in _measured:
        _measured[key] = df.agg(F.sum(row_bytes(df).cast("long"))).first()[0] or 0
    return _measured[key]


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark `df` for broadcast only when its rows are known to take less than `limit`.

    Anything larger joins by shuffle, where adaptive execution splits skewed
    partitions; the hint keeps the planner from broadcasting it on its file size.
    While its part of a shuffle partition is small, that part is hashed, so the
    large side is not sorted.
    """
    size = measured_bytes(df)
    if size <= limit:
        return F.broadcast(df)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("shuffle_hash" if size <= limit * parts / 2 else "merge")


def by_ship(name: str, other: str) -> Column:
    """Equality of two columns of a join that shall shuffle by its other key alone.

    Rows then stay where every further table of that key finds them.
    """
    return F.col(name).between(F.col(other), F.col(other))


def null_safe_equal(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition
