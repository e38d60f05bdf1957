"""Shore-power use at berth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux.functions.keyed import small_side

# Fixed value: shortest stay that uses shore power.
MIN_STAY_SECONDS = 2 * 3600


def join_port_usage(points: DataFrame, vessel_usage: DataFrame, type_usage: DataFrame) -> DataFrame:
    """Usage shares by vessel and port, and by vessel type and port.

    Overlapping periods of one key yield several rows per position, as the tables say.
    """
    day = F.to_date("date_time_utc")

    def lookup(usage: DataFrame, key: str, prefix: str) -> DataFrame:
        return small_side(
            usage.select(
                F.col(key).alias(f"_{prefix}_key"),
                F.col("municipality_no").alias(f"_{prefix}_municipality"),
                F.col("start_date").alias(f"_{prefix}_start"),
                F.col("end_date").alias(f"_{prefix}_end"),
                F.col("usage_percentage").alias(f"usage_percentage_{prefix}_port_electric"),
            )
        )

    for usage, key, point_key, prefix in (
        (vessel_usage, "vessel_id", "vessel_id", "vessel"),
        (type_usage, "vessel_type", "vessel_class", "vessel_type"),
    ):
        condition = (
            (F.col(point_key) == F.col(f"_{prefix}_key"))
            & (F.col("municipality_id") == F.col(f"_{prefix}_municipality"))
            & (day >= F.col(f"_{prefix}_start"))
            & (day <= F.col(f"_{prefix}_end"))
        )
        names = [f"_{prefix}_{part}" for part in ("key", "municipality", "start", "end")]
        points = points.join(lookup(usage, key, prefix), condition, "left").drop(*names)
    return points


def with_shore_power(points: DataFrame) -> DataFrame:
    """Flag, factor on what the ship burns itself, and phase 'p'.

    A flagged stay without any usage value has an unknown (NULL) factor.
    """
    flagged = (
        F.col("close_to_power")
        & (F.col("phase") == "n")
        & (F.col("sail_time_remaining_seconds") > MIN_STAY_SECONDS)
    )
    usage = F.coalesce(
        "usage_percentage_vessel_port_electric",
        "usage_percentage_vessel_type_port_electric",
        "shore_power_usage_percentage",
    )
    at_berth = F.coalesce(flagged, F.lit(False))
    return points.withColumns(
        {
            "electric_shore_power_at_berth": at_berth,
            "electric_shore_power_at_berth_reduction_factor": F.round(
                1 - F.when(at_berth, usage).otherwise(F.lit(0.0)), 2
            ),
            "phase": F.when(at_berth, F.lit("p")).otherwise(F.col("phase")),
        }
    )
