"""Specific fuel consumption and fuel use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux.config import DIESELS, DISTILLATE, ENGINES, LNG, METHANOL, RESIDUAL
from shipflux.functions.rules import Rule, decide
from shipflux.operators.parameters import (
    LNG_ENGINE_SLUGS,
    SLUG,
    THREE_YEAR_BANDS,
    TWO_YEAR_BANDS,
    Parameters,
)

OLD, NEW = TWO_YEAR_BANDS

# Which parameter is the main engine's baseline.
MAIN_RULES = [
    *(
        Rule({"engine": d, "fuel": f, "age": band}, f"sfc_main_engine_{SLUG[f]}_{d.lower()}_{band}")
        for d in DIESELS
        for f in (DISTILLATE, RESIDUAL)
        for band in THREE_YEAR_BANDS
    ),
    *(Rule({"engine": d, "fuel": METHANOL}, f"sfc_main_engine_methanol_{d.lower()}") for d in ("SSD", "MSD")),
    *(
        Rule({"engine": kind, "era": NEW}, f"sfc_main_engine_{LNG_ENGINE_SLUGS[kind]}_{NEW}")
        for kind in LNG_ENGINE_SLUGS
    ),
    *(
        Rule({"engine": kind, "era": OLD}, f"sfc_main_engine_{LNG_ENGINE_SLUGS[kind]}_{OLD}")
        for kind in ("LNG-Otto MS", "LBSI")
    ),
    *(
        Rule({"engine": turbine, "fuel": f}, f"sfc_main_engine_{SLUG[f]}_{turbine.lower()}")
        for turbine in ("ST", "GT")
        for f in (DISTILLATE, RESIDUAL, LNG)
    ),
]
PILOT_RULES = [
    Rule({"engine": kind, "era": NEW}, f"sfc_main_engine_{LNG_ENGINE_SLUGS[kind]}_{NEW}_pilot_fuel")
    for kind in ("LNG-Diesel", "LNG-Otto SS")
]
AUX_RULES = [
    *(
        Rule({"fuel": f, "age": band}, f"sfc_aux_{SLUG[f]}_{band}")
        for f in (DISTILLATE, RESIDUAL)
        for band in THREE_YEAR_BANDS
    ),
    Rule({"fuel": LNG, "era": OLD}, f"sfc_aux_lng_{OLD}"),
    Rule({"fuel": LNG}, f"sfc_aux_lng_{NEW}"),
]
BOILER_RULES = [Rule({"fuel": f}, f"sfc_boiler_{SLUG[f]}") for f in (DISTILLATE, RESIDUAL, LNG)]
EQUIVALENT_RULES = [
    Rule({"fuel": RESIDUAL}, "fuel_equivalent_hfo"),
    Rule({"fuel": DISTILLATE}, "fuel_equivalent_mdo"),
    Rule({"fuel": LNG}, "fuel_equivalent_lng"),
    Rule({"fuel": METHANOL}, "fuel_equivalent_methanol"),
]


def build_eras() -> dict[str, Column]:
    """Build-year bands of the fuel rules; years between 2000 and 2001 belong to no LNG era."""
    year = F.col("year_of_build")
    first, second, third = THREE_YEAR_BANDS
    return {
        "_age": F.when(year <= 1983, first).when(year <= 2000, second).when(year > 2000, third),
        "_era": F.when(year <= 2000, OLD).when(year >= 2001, NEW),
    }


FUEL_COLUMNS = {"engine": "main_engine_enginetype", "fuel": "main_engine_fueltype", "age": "_age", "era": "_era"}


def with_baselines(vessels: DataFrame, values: Parameters) -> DataFrame:
    """g/kWh of each engine, pilot fuel and diesel equivalent, constant per vessel period."""
    texts = {
        "sfc_main_engine_baseline": decide(MAIN_RULES, FUEL_COLUMNS, values.__getitem__),
        "sfc_pilot_fuel": decide(PILOT_RULES, FUEL_COLUMNS, values.__getitem__, "0D"),
        "sfc_aux": decide(AUX_RULES, FUEL_COLUMNS, values.__getitem__),
        "sfc_boiler": decide(BOILER_RULES, FUEL_COLUMNS, values.__getitem__),
        "mdo_equivalent": decide(EQUIVALENT_RULES, FUEL_COLUMNS, values.__getitem__),
    }
    aged = vessels.withColumns(build_eras())
    return aged.withColumns({name: F.expr(text) for name, text in texts.items()}).drop("_age", "_era")


def main_engine_sfc() -> Column:
    """Baseline adjusted by load; turbines keep the baseline."""
    return F.expr(
        """
        CASE WHEN main_engine_enginetype IN ('GT', 'ST') THEN sfc_main_engine_baseline
             ELSE sfc_main_engine_baseline * (
                    0.455D * main_engine_load_factor * main_engine_load_factor - 0.71D * main_engine_load_factor + 1.28D
                  ) + sfc_pilot_fuel END
        """
    )


def own_share() -> Column:
    """Share of energy that is neither battery nor shore power, per million."""
    return F.expr(
        "(1 - degree_of_electrification) * electric_shore_power_at_berth_reduction_factor / 1000000"
    )


def sum_known(names: list[str]) -> Column:
    """Sum of columns in which an unknown one counts as 0."""
    return F.expr(" + ".join(f"coalesce({name}, 0D)" for name in names))


def with_fuel(points: DataFrame) -> DataFrame:
    """Fuel per engine, total fuel and its marine-diesel equivalent."""
    sized = points.withColumns({"sfc_main_engine": main_engine_sfc(), "own_share": own_share()})
    burnt = sized.withColumns({f"{e}_fuel_tonnes": F.expr(f"sfc_{e} * {e}_kwh * own_share") for e in ENGINES})
    per_engine = [f"{e}_fuel_tonnes" for e in ENGINES]
    return burnt.withColumns(
        {
            "fuel_tonnes": sum_known(per_engine),
            "fuel_mdo_equivalent_tonnes": sum_known([f"mdo_equivalent * {fuel}" for fuel in per_engine]),
        }
    )
