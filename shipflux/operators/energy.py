"""Engine load and energy of one position report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux import config
from shipflux.functions.rules import Rule, case, decide, literal, matches

# Load limits, engine margin and power rules.
MAX_LOAD = 0.98
MIN_POSITIONING_LOAD = 0.1
ENGINE_MARGIN = 0.85
PHASE_MODES = [
    Rule({"phase": "a"}, "anchor"),
    Rule({"phase": ("aq", "dp-o", "f", "m")}, "maneuver"),
    Rule({"phase": "c"}, "cruise"),
    Rule({"phase": "n"}, "berth"),
]
TANKER_REDUCTION = 1 / 3
OTHER_REDUCTION = 3 / 4
HOUR = 3600
SMALL_ENGINE_KW = 150
MEDIUM_ENGINE_KW = 500
MEDIUM_ENGINE_AUX_SHARE = 0.05


def load_factor() -> Column:
    """Cube of speed over service speed, limited, and 0 at berth and anchor.

    CASE instead of least/greatest: an unknown load must stay NULL.
    """
    cube = "power(try_divide(speed_over_ground, speed_service), 3D)"
    return F.expr(
        case(
            [
                ("phase IN ('n', 'a')", "0D"),
                (f"phase = 'dp-o' AND {cube} < {literal(MIN_POSITIONING_LOAD)}", literal(MIN_POSITIONING_LOAD)),
                (f"{cube} < 0", "0D"),
                (f"{cube} > {literal(MAX_LOAD)}", literal(MAX_LOAD)),
            ],
            cube,
        )
    )


def main_engine_kwh() -> Column:
    return F.expr(
        f"main_engine_load_factor * main_engine_kw * {literal(ENGINE_MARGIN)} * delta_previous_point_seconds / {HOUR}"
    )


def phase_power(engine: str) -> str:
    """Power in kW of an auxiliary engine or boiler in the phase of the position."""
    return decide(PHASE_MODES, {"phase": "phase"}, lambda mode: f"{engine}_{mode}_kw", "0")


def berth_share() -> str:
    """Share of power that is left during a long stay at berth."""
    tanker = matches({"class": config.TANKER_CLASSES}, {"class": "vessel_class"})
    return case(
        [
            ("phase <> 'n'", "1D"),
            (f"{tanker} AND sail_time_remaining_seconds >= {48 * HOUR}", literal(TANKER_REDUCTION)),
            (f"NOT {tanker} AND sail_time_remaining_seconds >= {24 * HOUR}", literal(OTHER_REDUCTION)),
        ],
        "1D",
    )


def aux_boiler_kwh(engine: str) -> Column:
    """Energy by phase power; small ships have none, medium ones a share of the main engine for aux."""
    cases = [(f"main_engine_kw > 0 AND main_engine_kw <= {SMALL_ENGINE_KW}", "0D")]
    if engine == "aux":
        medium = f"main_engine_kw > {SMALL_ENGINE_KW} AND main_engine_kw <= {MEDIUM_ENGINE_KW}"
        share = f"main_engine_kw * {literal(MEDIUM_ENGINE_AUX_SHARE)} * delta_previous_point_seconds / {HOUR}"
        cases.append((medium, share))
    energy = f"{phase_power(engine)} * delta_previous_point_seconds / {HOUR} * {berth_share()}"
    return F.expr(case(cases, energy))


def with_energy(points: DataFrame) -> DataFrame:
    return points.withColumn("main_engine_load_factor", load_factor()).withColumns(
        {
            "main_engine_kwh": main_engine_kwh(),
            "aux_kwh": aux_boiler_kwh("aux"),
            "boiler_kwh": aux_boiler_kwh("boiler"),
        }
    )
