"""Position reports to emission facts."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux import config
from shipflux.functions.keyed import by_ship, keep_first, small_side
from shipflux.operators import areas, emissions, energy, factors, fuel, register, shore_power
from shipflux.operators.parameters import Parameters


class FactInputs(NamedTuple):
    """Tables the fact job reads."""

    vessels: DataFrame
    layers: dict[str, DataFrame]
    installations: DataFrame
    vessel_port_usage: DataFrame
    type_port_usage: DataFrame
    parameters: Parameters


class Lookups(NamedTuple):
    """What positions are joined to, prepared once for all date ranges of a run."""

    factors: DataFrame
    cells: dict[str, DataFrame]
    nearest_shore_power: DataFrame
    vessel_port_usage: DataFrame
    type_port_usage: DataFrame
    parameters: Parameters


def build_lookups(inputs: FactInputs) -> Lookups:
    return Lookups(
        factors.vessel_factors(register.eligible_vessels(inputs.vessels), inputs.parameters),
        areas.cell_lookups(inputs.layers),
        areas.nearest_shore_power(inputs.installations),
        inputs.vessel_port_usage,
        inputs.type_port_usage,
        inputs.parameters,
    )


def store_lookups(lookups: Lookups, folder: str) -> Lookups:
    """Write the lookups and read them back.

    They are then built once, later plans stay small, and the files give the planner
    the true sizes for its broadcast decisions.
    """
    spark = lookups.factors.sparkSession

    def store(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return lookups._replace(
        factors=store(lookups.factors, "factors"),
        cells={cell: store(df, cell) for cell, df in lookups.cells.items()},
        nearest_shore_power=store(lookups.nearest_shore_power, "shore_power"),
        vessel_port_usage=store(lookups.vessel_port_usage, "vessel_port_usage"),
        type_port_usage=store(lookups.type_port_usage, "type_port_usage"),
    )


POINT_COLUMNS = (
    "id", "vessel_id", "mmsi", "date_time_utc", "hex_14", "sail_id", "geometry_wkt", "speed_over_ground",
    "phase", "sail_time_remaining_seconds", "delta_previous_point_seconds", "distance_previous_point_meters",
    "in_coast_and_sea_area",
)
FACT_COLUMNS = (
    "id", "date_time_utc", "mmsi", "vessel_id", "phase", "sail_id", "geometry_wkt", "hex_14",
    "emission_control_area_id", "management_plan_marine_areas_area_id",
    "maritime_borders_norwegian_economic_zone_id", "maritime_borders_norwegian_continental_shelf_id",
    "shore_power_id", "municipality_id", "in_coast_and_sea_area",
    "electric_shore_power_at_berth_reduction_factor", "main_engine_load_factor", "main_engine_kwh", "aux_kwh",
    "boiler_kwh", "fuel_tonnes", "fuel_mdo_equivalent_tonnes", "bc_tonnes", "ch4_tonnes", "co_tonnes",
    "co2_tonnes", "n2o_tonnes", "nmvoc_tonnes", "nox_tonnes", "pm10_tonnes", "pm2_5_tonnes", "sox_tonnes",
    "co2e_tonnes", "delta_previous_point_seconds", "distance_previous_point_meters", "bi_processing_time",
    "version",
)


def interval_join(points: DataFrame, vessels: DataFrame) -> DataFrame:
    """Positions within a period of their vessel; `period_start` names the period.

    Only the period key is attached. The wide attributes follow after the
    deduplication shuffle, which therefore carries positions only.
    """
    periods = small_side(
        vessels.select(
            "vessel_id", F.col("start_date").alias("period_start"), F.col("end_date").alias("period_end")
        ),
    )
    day = F.to_date("date_time_utc")
    matched = points.join(periods, "vessel_id", "inner")
    return matched.filter((day >= F.col("period_start")) & (day <= F.col("period_end"))).drop("period_end")


def one_per_time(points: DataFrame) -> DataFrame:
    """One position per ship and time, in a total order of its columns."""
    order = ("id", "vessel_id", "period_start", "hex_14", "sail_id", "phase", "speed_over_ground",
             "delta_previous_point_seconds")
    return keep_first(points, ["mmsi", "date_time_utc"], [F.col(name).asc_nulls_first() for name in order])


def attach_vessels(points: DataFrame, vessel_factors: DataFrame) -> DataFrame:
    """Consumption and emission factors of the vessel period a position belongs to.

    A shuffle goes by ship alone, so port usage and whatever else is known by ship
    meets the positions where they are.
    """
    table = small_side(vessel_factors.drop("end_date").withColumnsRenamed({"vessel_id": "_v", "start_date": "_s"}))
    joined = points.join(table, (F.col("vessel_id") == F.col("_v")) & by_ship("period_start", "_s"), "inner")
    return joined.drop("_v", "_s")


def locate(points: DataFrame, lookups: Lookups) -> DataFrame:
    """Area layers, shore power and flags of every position."""
    with_layers = areas.join_cells(areas.with_parent_cells(points), lookups.cells)
    return areas.area_flags(areas.join_shore_power(with_layers, lookups.nearest_shore_power))


def unique_points(points: DataFrame, lookups: Lookups) -> DataFrame:
    """One position per ship and time, within a period of its vessel."""
    return one_per_time(interval_join(points.select(*POINT_COLUMNS), lookups.factors))


def enrich_unique(unique: DataFrame, lookups: Lookups) -> DataFrame:
    """Vessel attributes, areas and port usage of `unique_points`; further columns are kept."""
    located = locate(attach_vessels(unique, lookups.factors), lookups)
    return shore_power.join_port_usage(located, lookups.vessel_port_usage, lookups.type_port_usage)


def enrich(points: DataFrame, lookups: Lookups) -> DataFrame:
    """All joins of the fact job: vessel period, areas, port usage; one shuffle of positions."""
    return enrich_unique(unique_points(points, lookups), lookups)


def consume(points: DataFrame) -> DataFrame:
    """Energy (with the phase as reported), shore power, then fuel."""
    return fuel.with_fuel(shore_power.with_shore_power(energy.with_energy(points)))


def emit(points: DataFrame, parameters: Parameters) -> DataFrame:
    return emissions.with_totals(emissions.with_engine_emissions(points, parameters), parameters)


def emission_facts(
    points: DataFrame, lookups: Lookups, version: str = config.VERSION, stamp: Column | None = None
) -> DataFrame:
    """One fact row per position, 37 columns."""
    return facts_of(unique_points(points, lookups), lookups, version, stamp)


def facts_of(
    unique: DataFrame, lookups: Lookups, version: str = config.VERSION, stamp: Column | None = None,
    carried: Iterable[str] = (),
) -> DataFrame:
    """The facts of `unique_points`, with the `carried` columns they have besides."""
    calculated = emit(consume(enrich_unique(unique, lookups)), lookups.parameters)
    stamped = calculated.withColumns(
        {
            "bi_processing_time": F.current_timestamp() if stamp is None else stamp,
            "version": F.lit(version),
        }
    )
    return stamped.select(*FACT_COLUMNS, *carried)
