"""Reads of position reports and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux.operators.areas import with_parent_cells

AIS_COLUMNS = (
    "id", "vessel_id", "mmsi", "date_time_utc", "hex_14", "sail_id", "geometry_wkt", "speed_over_ground",
    "phase", "sail_time_remaining_seconds", "delta_previous_point_seconds", "distance_previous_point_meters",
    "new_ship_rep_location_id", "new_ship_rep_location_name", "unlocode_country_code",
    "unlocode_location_code", "unlocode_city", "country_start", "country_end", "voyage_type",
    "in_coast_and_sea_area", "ais_public_data", "ship_is_stopped", "msg_type",
)


def positions_between(positions: DataFrame, first: str, last: str) -> DataFrame:
    """Positions of an inclusive date range with the cells of the area layers.

    `date_utc` is the partition column, so only the wanted days are read.
    """
    day = F.col("date_utc")
    wanted = positions.filter((day >= F.lit(first).cast("date")) & (day <= F.lit(last).cast("date")))
    return with_parent_cells(wanted.select(*AIS_COLUMNS))


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or Parquet files when a path is given."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.read.table(name_or_path)
