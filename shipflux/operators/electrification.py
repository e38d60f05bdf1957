"""Battery periods and shore-power usage tables from their CSV drops."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux.functions.cleaning import clear_null_words, decimal_comma, spaced_int
from shipflux.functions.keyed import keep_first
from shipflux.operators.register import primary_identities


def _order(*names: str) -> list[Column]:
    return [F.col(name).asc_nulls_first() for name in names]


def clean_battery(bronze: DataFrame) -> DataFrame:
    """Typed battery rows, one per (mmsi, imo, start date)."""
    typed = clear_null_words(bronze, "route", "vessel_name").withColumns(
        {
            "degree_of_electrification": decimal_comma(F.col("degree_of_electrification")),
            "battery_pack_kwh": F.col("battery_pack_kwh").try_cast("int"),
        }
    )
    order = _order("end_date", "degree_of_electrification", "battery_pack_kwh", "route", "vessel_name")
    return keep_first(typed.fillna(0, subset=["imo"]), ["mmsi", "imo", "start_date"], order)


def battery_periods(silver: DataFrame, identities: DataFrame) -> DataFrame:
    """Battery periods by vessel, one per start date."""
    known = primary_identities(identities).select("vessel_id", "imo", "mmsi")
    joined = known.join(silver, ["imo", "mmsi"], "inner").select(
        "vessel_id", "mmsi", "imo", "degree_of_electrification", "battery_pack_kwh", "start_date", "end_date"
    )
    order = _order("mmsi", "imo", "end_date", "degree_of_electrification", "battery_pack_kwh")
    return keep_first(joined, ["vessel_id", "start_date"], order)


def clean_vessel_port(bronze: DataFrame) -> DataFrame:
    """Typed shore-power usage rows per vessel and port, one per (mmsi, imo, start date)."""
    typed = clear_null_words(bronze, "ship_name", "municipality_name").withColumn(
        "usage_percentage", decimal_comma(F.col("usage_percentage"))
    )
    order = _order("end_date", "municipality_name", "usage_percentage", "ship_name")
    return keep_first(typed.fillna(0, subset=["imo", "mmsi"]), ["mmsi", "imo", "start_date"], order)


def municipalities_of_year(municipalities: DataFrame, year: int) -> DataFrame:
    return municipalities.filter(F.col("year") == year)


def vessel_port_usage(silver: DataFrame, identities: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Shore-power usage by vessel and municipality number, one per start date."""
    known = primary_identities(identities).select("vessel_id", "imo", "mmsi")
    joined = (
        known.join(silver, ["imo", "mmsi"], "inner")
        .join(municipalities, "municipality_name", "inner")
        .select(
            "vessel_id", "mmsi", "imo", "municipality_no", "municipality_name",
            "usage_percentage", "start_date", "end_date",
        )
    )
    order = _order("mmsi", "imo", "end_date", "usage_percentage", "municipality_name")
    return keep_first(joined, ["vessel_id", "municipality_no", "start_date"], order)


def clean_type_port(bronze: DataFrame) -> DataFrame:
    """Typed shore-power usage rows per vessel type and port, one per start date."""
    typed = clear_null_words(bronze, "municipality_name").withColumn(
        "usage_percentage", decimal_comma(F.col("usage_percentage"))
    )
    order = _order("end_date", "usage_percentage")
    return keep_first(typed, ["vessel_type", "municipality_name", "start_date"], order)


def type_port_usage(silver: DataFrame, vessel_types: DataFrame, municipalities: DataFrame) -> DataFrame:
    """Shore-power usage by vessel type and municipality number, one per start date."""
    known_types = vessel_types.select("vessel_type").distinct()
    joined = (
        silver.filter(F.col("start_date").isNotNull())
        .join(municipalities, "municipality_name", "inner")
        .join(known_types, "vessel_type", "inner")
        .select(
            "vessel_type", "municipality_no", "municipality_name",
            "usage_percentage", "start_date", "end_date",
        )
    )
    order = _order("end_date", "usage_percentage", "municipality_name")
    return keep_first(joined, ["vessel_type", "municipality_no", "start_date"], order)


def unmatched(rows: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """Distinct names that the lookup table does not know, for review."""
    lookup = known.select(name).distinct()
    return rows.select(name).distinct().join(lookup, name, "left_anti")


def spaced_battery(bronze: DataFrame) -> DataFrame:
    """Typing of the older battery drop: decimal comma, blanks inside numbers."""
    return bronze.withColumns(
        {
            "degree_of_electrification": decimal_comma(F.col("degree_of_electrification")).cast("float"),
            "battery_pack_kwh": spaced_int(F.col("battery_pack_kwh")),
        }
    )


def close_open_periods(usage: DataFrame, today: Column | None = None) -> DataFrame:
    """Usage without an end holds until today."""
    day = F.current_date() if today is None else today
    return usage.withColumn("end_date", F.coalesce("end_date", day))
