"""Emissions of one position report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux.config import DIESELS, ENGINES, LNG, POLLUTANTS
from shipflux.functions.rules import case, literal, matches
from shipflux.operators.factors import PLAIN, factor
from shipflux.operators.fuel import sum_known
from shipflux.operators.parameters import (
    LOW_LOAD_EDGES,
    LOW_LOAD_POLLUTANTS,
    Parameters,
    low_load_bin_names,
)

ENERGY_POLLUTANTS = ("ch4", "co", "n2o", "nmvoc", "nox")


def with_area_factors(points: DataFrame) -> DataFrame:
    """Choose the factor array of the waters a position lies in."""
    return points.withColumn(
        "area_factors", F.when(F.col("eca"), F.col("factors_eca")).otherwise(F.col("factors_global"))
    )


# Black carbon factor of the main engine: a load curve, a flat value, or 0 without load.
# Without load it is 0 for diesels, and in an ECA for every engine.
SOOT_CURVE = (
    f"{factor('bc_main_engine_coefficient')} * power(main_engine_load_factor, {factor('bc_main_engine_exponent')})"
)
SOOT_MAIN_FACTOR = f"""
CASE WHEN main_engine_load_factor > 0 THEN coalesce({SOOT_CURVE}, {factor('bc_main_engine_flat')})
     WHEN eca OR {matches({'engine': DIESELS}, PLAIN)} THEN 0D
     ELSE {factor('bc_main_engine_flat')} END
"""
# Per energy for gas fuel and turbines (without the shore-power share), per fuel otherwise.
SOOT_MAIN_ACTIVITY = f"""
CASE WHEN main_engine_fueltype = '{LNG}' OR main_engine_enginetype IN ('ST', 'GT')
     THEN main_engine_kwh * (1 - degree_of_electrification) / 1000000
     ELSE main_engine_fuel_tonnes END
"""
PARTICLE_MAIN_FACTOR = f"""
CASE WHEN {factor('pm_main_engine_slope')} IS NULL THEN {factor('pm_main_engine_base')}
     ELSE {factor('pm_main_engine_base')} + {factor('pm_main_engine_slope')} * sfc_main_engine END
"""


def engine_tonnes(engine: str) -> dict[str, str]:
    """Tonnes of every pollutant from one engine, before the low-load multiplier."""
    energy, fuel = f"{engine}_own_kwh", f"{engine}_fuel_tonnes"
    tonnes = {name: f"{factor(f'{name}_{engine}')} * {energy}" for name in ENERGY_POLLUTANTS}
    tonnes["co2"] = f"{factor('cf')} * {fuel}"
    tonnes["sox"] = f"{factor(f'sox_{engine}')} * {fuel}"
    if engine == "main_engine":
        tonnes["bc"] = f"({SOOT_MAIN_FACTOR}) * ({SOOT_MAIN_ACTIVITY})"
        tonnes["pm10"] = f"({PARTICLE_MAIN_FACTOR}) * {energy}"
    else:
        tonnes["bc"] = f"{factor(f'bc_{engine}')} * {energy}"
        tonnes["pm10"] = f"{factor(f'pm_{engine}')} * {energy}"
    return tonnes


def low_load_bin() -> Column:
    """Number of the left-open load bin, 0 outside all of them."""
    bins = [(f"main_engine_load_factor <= {literal(high)}", str(n)) for n, high in enumerate(LOW_LOAD_EDGES)]
    return F.expr(case(bins, "0"))


def low_load_multiplier(values: Parameters, pollutant: str) -> Column:
    """Multiplier of the bin, from an array that Catalyst folds to a constant."""
    steps = [values[f"low_load_{pollutant}_main_engine_{span}"] for span in low_load_bin_names()]
    return F.expr(f"array(1D, {', '.join(steps)})[low_load_bin]")


def with_engine_emissions(points: DataFrame, values: Parameters) -> DataFrame:
    """`{pollutant}_{engine}_tonnes` for all pollutants and engines, and PM2.5.

    PM2.5 is taken from the main engine before the low-load multiplier.
    """
    own_kwh = {f"{engine}_own_kwh": F.col(f"{engine}_kwh") * F.col("own_share") for engine in ENGINES}
    rows = with_area_factors(points).withColumns({"low_load_bin": low_load_bin(), **own_kwh})
    rows = rows.withColumns(
        {
            f"{name}_{engine}_tonnes": F.expr(text)
            for engine in ENGINES
            for name, text in engine_tonnes(engine).items()
        }
    )
    names = {name: f"{name}_main_engine_tonnes" for name in LOW_LOAD_POLLUTANTS}
    multiplied = {
        column: low_load_multiplier(values, name) * F.col(column) for name, column in names.items()
    }
    return rows.withColumns(
        {"pm2_5_tonnes": F.col("pm10_main_engine_tonnes") * values.column("pm_2_5"), **multiplied}
    )


def with_totals(points: DataFrame, values: Parameters) -> DataFrame:
    """Sums over the engines, an unknown engine counting as 0, and the CO2 equivalent."""
    summed = points.withColumns(
        {
            f"{pollutant}_tonnes": sum_known([f"{pollutant}_{engine}_tonnes" for engine in ENGINES])
            for pollutant in POLLUTANTS
        }
    )
    warming = (f"{gas}_tonnes * {values[f'co2e_gwp100_{gas}']}" for gas in ("co2", "ch4", "n2o"))
    return summed.withColumn("co2e_tonnes", F.expr(" + ".join(warming)))
