"""Emission factors per vessel period.

Everything about a factor that does not depend on the position is worked out once
per vessel period and packed into two arrays, one for global waters and one for
emission control areas (ECA). A position then picks its array once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux import config
from shipflux.config import DIESELS, DISTILLATE, ELECTRIC, ENGINES, LNG, METHANOL, RESIDUAL
from shipflux.functions.rules import Rule, case, decide, literal, matches
from shipflux.operators.fuel import with_baselines
from shipflux.operators.parameters import LNG_ENGINE_SLUGS, SLUG, Parameters

GLOBAL, ECA = "global", "eca"
AREAS = (GLOBAL, ECA)


def by_fuel(pollutant: str, engine: str) -> list[Rule]:
    """Auxiliary and boiler factors depend on the fuel only."""
    return [Rule({"fuel": fuel}, f"{pollutant}_{engine}_{SLUG[fuel]}") for fuel in (RESIDUAL, DISTILLATE, LNG)]


def lng_engines(pollutant: str, kinds=tuple(LNG_ENGINE_SLUGS)) -> list[Rule]:
    return [Rule({"engine": kind}, f"{pollutant}_main_engine_{LNG_ENGINE_SLUGS[kind]}") for kind in kinds]


def turbine(pollutant: str, kind: str, *fuels: str) -> list[Rule]:
    """Named fuels first, then the turbine's general value."""
    name = f"{pollutant}_main_engine_{kind.lower()}"
    special = [Rule({"engine": kind, "fuel": fuel}, f"{name}_{SLUG[fuel]}") for fuel in fuels]
    return [*special, Rule({"engine": kind}, name)]


def turbines(pollutant: str, *fuels: str) -> list[Rule]:
    return [*turbine(pollutant, "GT", *fuels), *turbine(pollutant, "ST", *fuels)]


def combustion(pollutant: str) -> list[Rule]:
    """CO and N2O of the main engine."""
    diesel = [
        Rule({"engine": d, "fuel": fuel}, f"{pollutant}_main_engine_{d.lower()}_{SLUG[fuel]}")
        for d in DIESELS
        for fuel in (RESIDUAL, DISTILLATE)
    ]
    methanol = Rule({"fuel": METHANOL}, f"{pollutant}_main_engine_methanol")
    return [methanol, *diesel, *turbines(pollutant, LNG, DISTILLATE), *lng_engines(pollutant)]


# Which parameter is the factor, first match wins.
CARBON_RULES = [
    Rule({"fuel": RESIDUAL}, "cf_residual_fuel"),
    Rule({"fuel": DISTILLATE}, "cf_distillate_fuel"),
    Rule({"fuel": LNG}, "cf_lng"),
    Rule({"fuel": METHANOL}, "cf_methanol"),
]
METHANE_MAIN_RULES = [
    Rule({"fuel": METHANOL}, "ch4_main_engine_methanol"),
    *(Rule({"engine": d}, f"ch4_main_engine_{d.lower()}") for d in DIESELS),
    *lng_engines("ch4"),
    *turbines("ch4", LNG),
]
VOC_MAIN_RULES = [
    *(Rule({"engine": d, "fuel": METHANOL}, f"nmvoc_main_engine_{d.lower()}_methanol") for d in ("SSD", "MSD")),
    *(Rule({"engine": d}, f"nmvoc_main_engine_{d.lower()}") for d in DIESELS),
    *turbines("nmvoc", LNG),
    *lng_engines("nmvoc"),
]
SOOT_FLAT_RULES = [
    *(Rule({"fuel": LNG, "engine": kind}, f"bc_main_engine_{slug}") for kind, slug in LNG_ENGINE_SLUGS.items()),
    *(Rule({"fuel": LNG, "engine": kind}, f"bc_main_engine_lng_{kind.lower()}") for kind in ("GT", "ST")),
    Rule({"fuel": RESIDUAL, "engine": "GT"}, "bc_main_engine_residual_fuel_gt"),
    Rule({"fuel": RESIDUAL, "engine": "ST"}, "bc_main_engine_residual_fuel_st"),
    # Distillate turbines use the residual steam-turbine value.
    Rule({"fuel": DISTILLATE, "engine": ("GT", "ST")}, "bc_main_engine_residual_fuel_st"),
]
# Black carbon = coefficient * load ^ exponent, by fuel and stroke.
SOOT_CURVES = {
    (RESIDUAL, 2): (1.5e-4, -0.359),
    (RESIDUAL, 4): (2.5e-4, -0.968),
    (DISTILLATE, 2): (3.11e-5, -0.397),
    (DISTILLATE, 4): (1.201e-4, -1.124),
    (METHANOL, 2): (1.5e-5, -0.359),
    (METHANOL, 4): (2.5e-5, -0.968),
}
# NOx by engine speed, coefficient * rpm ^ exponent.
NOX_CURVES = {1: (45.0, -0.2), 2: (44.0, -0.23), 3: (9.0, -0.2)}
# Sulphur and particle equations.
SULPHUR_TO_SOX = 2 * 0.97753
PARTICLES_PER_SULPHUR = 7 * 0.02247
PARTICLE_LINES = {RESIDUAL: (1.35, 0.0246), DISTILLATE: (0.23, 0.0024)}
METHANOL_PARTICLE_SHARE = 0.1
PARTICLE_LNG_ENGINES = {"LNG-Otto SS": "otto_ss", "LNG-Otto MS": "otto_ms", "LBSI": "lbsi", "GT": "gt", "ST": "st"}


# The fuel a factor is looked up for. Residual fuel is not burnt in an ECA; distillate
# replaces it. Some tables make the switch for diesel engines only.
PLAIN = {"engine": "main_engine_enginetype", "fuel": "main_engine_fueltype"}
SWITCHED = {GLOBAL: PLAIN, ECA: {**PLAIN, "fuel": "_eca_fuel"}}
DIESEL_SWITCHED = {GLOBAL: PLAIN, ECA: {**PLAIN, "fuel": "_eca_diesel_fuel"}}
IS_DIESEL = matches({"engine": DIESELS}, PLAIN)


def with_eca_fuels(vessels: DataFrame) -> DataFrame:
    residual = f"main_engine_fueltype = '{RESIDUAL}'"
    return vessels.withColumns(
        {
            "_eca_fuel": F.expr(case([(residual, literal(DISTILLATE))], "main_engine_fueltype")),
            "_eca_diesel_fuel": F.expr(
                case([(f"{residual} AND {IS_DIESEL}", literal(DISTILLATE))], "main_engine_fueltype")
            ),
        }
    )


def nox_main(values: Parameters, area: str) -> str:
    electric = (f"main_engine_fueltype = '{ELECTRIC}'", "0D")

    def by_tier(level: int, fallback: str | None = None) -> str:
        name = f"nox_main_engine_tier_{level}"
        cases = [("main_engine_enginetype = 'LNG-Diesel'", values[f"{name}_lng_diesel"])]
        if level == 3:
            cases.append(electric)
        if level in NOX_CURVES:
            coefficient, exponent = NOX_CURVES[level]
            cases += [
                ("main_engine_rpm > 0 AND main_engine_rpm < 130", values[f"{name}_rpm_1_129"]),
                ("main_engine_rpm >= 130 AND main_engine_rpm < 2000",
                 f"{literal(coefficient)} * power(main_engine_rpm, {literal(exponent)})"),
                ("main_engine_rpm >= 2000", values[f"{name}_rpm_2000_"]),
            ]
        cases += [(f"main_engine_enginetype = '{d}'", values[f"{name}_{d.lower()}"]) for d in DIESELS]
        return case(cases, fallback)

    fixed = [*turbines("nox", LNG), *lng_engines("nox", ("LNG-Otto SS", "LNG-Otto MS", "LBSI"))]
    tiers = [
        electric,
        ("tier_group_nox = 0", by_tier(0)),
        ("tier_group_nox = 1", by_tier(1)),
        ("tier_group_nox IN (2, 3)", by_tier(2)),
    ]
    everywhere = decide(fixed, PLAIN, values.__getitem__, case(tiers))
    return everywhere if area == GLOBAL else case([("tier_group_nox = 3", by_tier(3, everywhere))], everywhere)


def sulphur_fraction(values: Parameters, area: str) -> str:
    if area == ECA:
        return values["fuel_sulfur_fraction_eca"]
    rules = [Rule({"fuel": f}, f"fuel_sulfur_fraction_global_{SLUG[f]}") for f in (DISTILLATE, RESIDUAL)]
    return decide(rules, PLAIN, values.__getitem__, values["fuel_sulfur_fraction_global"])


def sox(values: Parameters, engine: str, area: str) -> str:
    oil = f"{literal(SULPHUR_TO_SOX)} * {sulphur_fraction(values, area)}"
    return case(
        [
            (matches({"fuel": (RESIDUAL, DISTILLATE)}, PLAIN), oil),
            (matches({"fuel": LNG}, PLAIN), values[f"sox_{engine}_lng"]),
            (matches({"fuel": METHANOL}, PLAIN), values[f"sox_{engine}_methanol"]),
        ]
    )


def particle_line(values: Parameters, engine: str, area: str) -> tuple[str, str]:
    """PM10 factor as base + slope * g/kWh; the slope is NULL where the factor is a constant."""
    sulphur = sulphur_fraction(values, area)

    def line(name: str, share: float = 1.0) -> tuple[str, str]:
        base, offset = PARTICLE_LINES[name]
        slope = f"({sulphur} - {literal(offset)}) * {literal(PARTICLES_PER_SULPHUR * share)}"
        return case([(f"({slope}) IS NOT NULL", literal(base * share))]), slope

    lines = {
        RESIDUAL: line(RESIDUAL),
        DISTILLATE: line(DISTILLATE),
        METHANOL: line(RESIDUAL, METHANOL_PARTICLE_SHARE),
    }
    gas = case(
        (
            (f"main_engine_enginetype = '{kind}'", values[f"pm_{engine}_lng_{slug}"])
            for kind, slug in PARTICLE_LNG_ENGINES.items()
        ),
        values[f"pm_{engine}_lng_otto_ms"],
    )
    is_fuel = {name: f"main_engine_fueltype = '{name}'" for name in (*lines, LNG)}
    base = case([*((is_fuel[name], parts[0]) for name, parts in lines.items()), (is_fuel[LNG], gas)])
    slope = case((is_fuel[name], parts[1]) for name, parts in lines.items())
    return base, slope


def on_line(base: Column, slope: Column, sfc: Column) -> Column:
    return F.when(slope.isNull(), base).otherwise(base + slope * sfc)


def soot_curve(area: str) -> tuple[str, str]:
    """Coefficient and exponent of the load curve; NULL where a flat factor or none applies.

    In an ECA the switch to the distillate curve looks at fuel and stroke only, so
    residual-fuelled turbines take it as well.
    """
    def burns(fuel: str, strokes: int) -> str:
        return f"main_engine_fueltype = '{fuel}' AND stroketype = {strokes}"

    cases = [(f"{IS_DIESEL} AND {burns(*key)}", curve) for key, curve in SOOT_CURVES.items()]
    if area == ECA:
        cases = [(burns(RESIDUAL, strokes), SOOT_CURVES[DISTILLATE, strokes]) for strokes in (2, 4)] + cases
    coefficient, exponent = (case((test, literal(curve[part])) for test, curve in cases) for part in (0, 1))
    return coefficient, exponent


def soot_flat(values: Parameters) -> str:
    return case([(IS_DIESEL, "NULL")], decide(SOOT_FLAT_RULES, PLAIN, values.__getitem__))


def area_factors(values: Parameters, area: str) -> dict[str, Column]:
    """All factors of one area by name, for vessels with baselines and ECA fuels."""
    def pick(rules: list[Rule], columns: dict[str, str], otherwise: str | None = None) -> str:
        return decide(rules, columns, values.__getitem__, otherwise)

    coefficient, exponent = soot_curve(area)
    base, slope = particle_line(values, "main_engine", area)
    texts = {
        "cf": pick(CARBON_RULES, SWITCHED[area], values["cf_other"]),
        "fuel_sulfur_fraction": sulphur_fraction(values, area),
        "bc_main_engine_coefficient": coefficient,
        "bc_main_engine_exponent": exponent,
        "bc_main_engine_flat": soot_flat(values),
        "ch4_main_engine": pick(METHANE_MAIN_RULES, PLAIN),
        "co_main_engine": pick(combustion("co"), DIESEL_SWITCHED[area]),
        "n2o_main_engine": pick(combustion("n2o"), DIESEL_SWITCHED[area]),
        "nmvoc_main_engine": pick(VOC_MAIN_RULES, PLAIN),
        "nox_main_engine": nox_main(values, area),
        "pm_main_engine_base": base,
        "pm_main_engine_slope": slope,
    }
    for name in ("aux", "boiler"):
        for pollutant in ("bc", "co", "n2o", "nox"):
            texts[f"{pollutant}_{name}"] = pick(by_fuel(pollutant, name), SWITCHED[area])
        for pollutant in ("ch4", "nmvoc"):
            texts[f"{pollutant}_{name}"] = pick(by_fuel(pollutant, name), PLAIN)
    for name in ENGINES:
        texts[f"sox_{name}"] = sox(values, name, area)
    factors = {name: F.expr(text) for name, text in texts.items()}
    for name in ("aux", "boiler"):
        line = (F.expr(text) for text in particle_line(values, name, area))
        factors[f"pm_{name}"] = on_line(*line, F.col(f"sfc_{name}"))
    return factors


# Order of the factor arrays.
FACTOR_NAMES = (
    "cf", "fuel_sulfur_fraction",
    "bc_main_engine_coefficient", "bc_main_engine_exponent", "bc_main_engine_flat",
    "ch4_main_engine", "co_main_engine", "n2o_main_engine", "nmvoc_main_engine", "nox_main_engine",
    "pm_main_engine_base", "pm_main_engine_slope",
    "bc_aux", "co_aux", "n2o_aux", "nox_aux", "ch4_aux", "nmvoc_aux", "pm_aux",
    "bc_boiler", "co_boiler", "n2o_boiler", "nox_boiler", "ch4_boiler", "nmvoc_boiler", "pm_boiler",
    "sox_main_engine", "sox_aux", "sox_boiler",
)


def factor(name: str) -> str:
    """One factor of the area a position lies in, as SQL."""
    return f"area_factors[{FACTOR_NAMES.index(name)}]"


PERIOD_COLUMNS = (
    "vessel_id", "start_date", "end_date", "vessel_class", "main_engine_fueltype",
    "main_engine_enginetype", "speed_service", "degree_of_electrification", "main_engine_kw",
    *(f"{engine}_{mode}_kw" for engine in ("aux", "boiler") for mode in config.OPERATING_MODES),
    "sfc_main_engine_baseline", "sfc_pilot_fuel", "sfc_aux", "sfc_boiler", "mdo_equivalent",
)


def with_named_factors(vessels: DataFrame, values: Parameters) -> DataFrame:
    """Consumption baselines and every factor as a column of its own, `{factor}_{area}`."""
    based = with_eca_fuels(with_baselines(vessels, values))
    named = {
        f"{name}_{area}": column.cast("double")
        for area in AREAS
        for name, column in area_factors(values, area).items()
    }
    return based.withColumns(named).drop("_eca_fuel", "_eca_diesel_fuel")


def vessel_factors(vessels: DataFrame, values: Parameters) -> DataFrame:
    """The narrow per-period table that positions are joined to."""
    based = with_eca_fuels(with_baselines(vessels, values))
    arrays = {}
    for area in AREAS:
        by_name = area_factors(values, area)
        arrays[f"factors_{area}"] = F.array(*(by_name[name].cast("double") for name in FACTOR_NAMES))
    return based.select(*PERIOD_COLUMNS, *(column.alias(name) for name, column in arrays.items()))
