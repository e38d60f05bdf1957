"""Auxiliary-engine and boiler power by vessel type and size bin."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipflux import config
from shipflux.functions.keyed import keep_first

POWER_COLUMNS = tuple(
    f"{engine}_{mode}_kw" for engine in ("aux", "boiler") for mode in config.OPERATING_MODES
)


def latest_batch(bronze: DataFrame) -> DataFrame:
    """Rows of the newest delivery that name a vessel type.

    The newest stamp is one scalar, so no ranking of the whole table is needed.
    """
    newest = bronze.select(F.max("bi_ingested_timestamp").alias("newest")).scalar()
    return bronze.filter((F.col("bi_ingested_timestamp") == newest) & F.col("vessel_type").isNotNull())


def open_top_bin(bins: DataFrame) -> DataFrame:
    """The bin with the highest lower limit of each vessel type has no upper limit."""
    highest = bins.groupBy("vessel_type").agg(F.max("low_limit").alias("low_limit_max"))
    return bins.join(highest, "vessel_type", "inner").withColumn(
        "high_limit",
        F.when(F.col("low_limit") == F.col("low_limit_max"), F.lit(config.OPEN_HIGH_LIMIT)).otherwise(
            F.col("high_limit")
        ),
    ).drop("low_limit_max")


def unknown_bins(bins: DataFrame) -> DataFrame:
    """One bin 0 per type and unit that catches vessels of unknown size, without power values."""
    return (
        bins.select("vessel_type", "vessel_type_id", "unit")
        .distinct()
        .withColumns(
            {
                "low_limit": F.lit(config.UNKNOWN_NUMBER),
                "high_limit": F.lit(0),
                "size_bin": F.lit(0),
                **{name: F.lit(None).cast("int") for name in POWER_COLUMNS},
            }
        )
    )


def build_size_bins(bronze: DataFrame) -> DataFrame:
    """Bronze deliveries to the bin table: newest batch, open top bin, unknown bin."""
    columns = ["vessel_type", "vessel_type_id", "unit", "low_limit", "high_limit", "size_bin", *POWER_COLUMNS]
    renamed = latest_batch(bronze).withColumnsRenamed({name.removesuffix("_kw"): name for name in POWER_COLUMNS})
    bins = open_top_bin(renamed.dropna(how="all")).select(*columns)
    return bins.unionByName(unknown_bins(bins))


def unique_bins(bins: DataFrame) -> DataFrame:
    """One row per vessel type and bin, the one with the lowest limit."""
    order = [F.col(name).asc_nulls_first() for name in ("low_limit", "high_limit", "unit", *POWER_COLUMNS)]
    return keep_first(bins, ["vessel_type", "size_bin"], order)


def unpivot_sizes(vessels: DataFrame) -> DataFrame:
    """One row per vessel period and size measure."""
    ids = ["vessel_id", "vessel_type_imo_ghg", "start_date"]
    return vessels.select(*ids, *config.SIZE_UNITS).unpivot(ids, list(config.SIZE_UNITS), "unit", "unit_value")


def match_size_bins(vessels: DataFrame, bins: DataFrame) -> DataFrame:
    """Power values of the bin each vessel period falls into (lower limit inclusive)."""
    sizes = unpivot_sizes(vessels)
    table = unique_bins(bins).withColumnRenamed("unit", "bin_unit")
    condition = (
        (sizes["vessel_type_imo_ghg"] == table["vessel_type"])
        & (sizes["unit"] == table["bin_unit"])
        & (sizes["unit_value"] >= table["low_limit"])
        & (sizes["unit_value"] < table["high_limit"])
    )
    return sizes.join(table, condition, "inner").select("vessel_id", "start_date", *POWER_COLUMNS)
