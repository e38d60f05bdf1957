"""Slowly changing tables, rebuilt or refreshed from append-only bronze."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipflux.functions.cleaning import day_month_year, decimal_comma
from shipflux.functions.keyed import keep_first, null_safe_equal


def type_variables(bronze: DataFrame) -> DataFrame:
    """Values with decimal comma and day.month.year dates; bad fields become NULL."""
    return bronze.withColumns(
        {
            "value": decimal_comma(F.col("value")),
            "start_date": day_month_year(F.col("start_date")),
            "end_date": day_month_year(F.col("end_date")),
        }
    )


def _ties(names: Sequence[str]) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in names]


def scd1(changes: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The latest row per key; equal sequence values are settled by the remaining columns."""
    rest = [name for name in changes.columns if name not in (*keys, sequence)]
    return keep_first(changes, keys, [F.col(sequence).desc_nulls_last(), *_ties(rest)])


def scd2(
    changes: DataFrame, keys: Sequence[str], sequence: str, bucket: Column | None = None
) -> DataFrame:
    """Every version per key with `__START_AT` and `__END_AT`; the sequence column is left out.

    Late rows find their place by sequence value. A row that repeats the version
    before it adds none.

    A key may hold a large part of all rows, so its history is cut into buckets of
    the sequence (days by default). Windows run inside a bucket; across buckets only
    one summary row per bucket is ordered.
    """
    rest = [name for name in changes.columns if name not in (*keys, sequence)]
    part = [*keys, "_bucket"]
    in_bucket = Window.partitionBy(*part).orderBy(sequence)
    across = Window.partitionBy(*keys).orderBy("_bucket")
    state = F.struct(*rest)
    step = F.date_trunc("DAY", F.col(sequence)) if bucket is None else bucket

    # Dealt by bucket once: both readers of the steps find them in one shuffle, and no window moves them again.
    steps = keep_first(changes, [*keys, sequence], _ties(rest)).withColumn("_bucket", step).repartition(*part)

    def with_bucket_fact(rows: DataFrame, facts: DataFrame) -> DataFrame:
        renamed = facts.withColumnsRenamed({key: f"_r_{key}" for key in part})
        same = F.lit(True)
        for key in part:
            same = same & rows[key].eqNullSafe(renamed[f"_r_{key}"])
        return rows.join(renamed, same, "left").drop(*(f"_r_{key}" for key in part))

    last_states = steps.groupBy(*part).agg(F.max_by(state, sequence).alias("_state"))
    carried = last_states.select(*part, F.lag("_state").over(across).alias("_carried"))
    marked = with_bucket_fact(
        steps.withColumn("_previous", F.lag(state).over(in_bucket)), carried
    )
    versions = marked.filter(~F.coalesce("_previous", "_carried").eqNullSafe(state)).drop("_previous", "_carried")

    first_starts = versions.groupBy(*part).agg(F.min(sequence).alias("_start"))
    following = first_starts.select(*part, F.lead("_start").over(across).alias("_following"))
    ended = with_bucket_fact(
        versions.withColumn("_next", F.lead(sequence).over(in_bucket)), following
    )
    return ended.select(
        *keys,
        *rest,
        F.col(sequence).alias("__START_AT"),
        F.coalesce("_next", "_following").alias("__END_AT"),
    )


def scd2_refresh(current: DataFrame, bronze: DataFrame, batch: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """The type-2 table after a batch: only keys in the batch are rebuilt from bronze."""
    touched = batch.select(*keys).distinct()
    rest = [name for name in current.columns if name not in ("__START_AT", "__END_AT")]
    source = bronze.select(*rest, sequence)
    rebuilt = scd2(source.join(touched, null_safe_equal(source, touched, keys), "left_semi"), keys, sequence)
    kept = current.join(touched, null_safe_equal(current, touched, keys), "left_anti")
    return kept.unionByName(rebuilt)
