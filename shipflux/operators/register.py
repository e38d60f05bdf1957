"""The vessel register: merging sources, classification and imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipflux import config
from shipflux.config import DISTILLATE, ELECTRIC, LNG, METHANOL, RESIDUAL
from shipflux.functions.rules import Rule, bands, case, decide, literal
from shipflux.operators.size_bins import POWER_COLUMNS, match_size_bins

# Propulsion text of the engine register and its code.
PROPULSION_CODES = {
    "Battery-Electric": "BE",
    "Gas Turbine(s) & Diesel Elec.": "GGDE",
    "Gas Turbine(s) Or Diesel Elec.": "GGDX",
    "Gas Turbine(s), Electric Drive": "GE",
    "Gas Turbine(s), Geared Drive": "GG",
    "Oil Eng(s) & Gas Turb(s) El.Dr": "DEGE",
    "Oil Eng(s) Direct Dr, Aux Sail": "DDWS",
    "Oil Eng(s), Elec-Dr, Aux Sail": "DEWS",
    "Oil Eng(s), Geared, Aux Sail": "DGWS",
    "Oil Engine(s), Direct Drive": "DD",
    "Oil Engine(s), Drive Unknown": "DU",
    "Oil Engine(s), Electric Drive": "DE",
    "Oil Engine(s), Geared Drive": "DG",
    "Oil Engines, Direct & Elec. Dr": "DDDE",
    "Oil Engines, Elec. & Direct Dr": "DEDD",
    "Oil Engines, Elec. & Geared Dr": "DEDG",
    "Oil Engines, F&S, Geared Drive": "DGDG",
    "Oil Engines, Geared & Elec. Dr": "DGDE",
    "Oil Engs & Fuel Cell-Electric": "AE",
    "Oil Engs & Gas Turb(s), Geared": "DGGG",
    "Petrol Engine(s), Direct Drive": "PD",
    "S.Turb, Gear & Oil Eng(s), Ele": "SGDE",
    "Sail, Aux Oil Eng(s) Direct-Dr": "WSDD",
    "Sail, Aux Oil Eng(s), Elec Dr.": "WSDE",
    "Sail, Aux Oil Eng(s), Geared": "WSDG",
    "St. Turb(s) Elec Dr. Or D.E.": "SEDX",
    "Steam Recip(s), Direct Drive": "RD",
    "Steam Turbine(s), Elec.Drive": "SE",
    "Steam Turbine(s), Geared Drive": "SG",
}

# Code groups of the engine register.
GAS_CODES = ("LG", "GB", "LP")
OPEN_CODES = ("NN", "UU", "YY")
STEAM_DRIVES = ("SG", "SGDE", "SE", "SEDX")
GAS_TURBINE_DRIVES = ("GG", "DEGE", "GE", "GGDE", "DGGG")
SAIL_DRIVES = ("WSDG", "WSDD", "WSDE")
OIL_DRIVES = ("DDWS", "DEWS", "DGWS", "DD", "DU", "DE", "DG", "DDDE", "DEDD", "DEDG", "DGDG", "DGDE")
LEAN_BURN_BUILDERS = ("Rolls-Royce Marine AS - Norway", "Bergen Engines AS - Norway")

# Main-engine fuel by register codes, first match wins.
FUEL_RULES = [
    Rule({"code1": GAS_CODES}, LNG),
    Rule({"code2": GAS_CODES}, LNG),
    Rule({"code1": "RF", "drive": STEAM_DRIVES, "imo_type": "Liquefied gas tanker"}, LNG),
    Rule({"code2": "RF", "drive": STEAM_DRIVES, "imo_type": "Liquefied gas tanker"}, LNG),
    Rule({"code1": "CU", "code2": OPEN_CODES}, "Coal"),
    Rule({"code1": "NU"}, "Nuclear"),
    Rule({"code2": "NU"}, "Nuclear"),
    Rule({"code1": "HY"}, "Hydrogen"),
    Rule({"code1": "ME"}, METHANOL),
    Rule({"drive": "BE"}, ELECTRIC),
    Rule({"code1": "RF"}, RESIDUAL),
    Rule({"code2": "RF"}, RESIDUAL),
    Rule({"code1": "DF", "code2": ("DF", *OPEN_CODES)}, DISTILLATE),
    Rule({"code1": OPEN_CODES, "code2": "DF"}, DISTILLATE),
    Rule({"code1": "CU", "code2": "DF"}, DISTILLATE),
    Rule({"imo_type": "Miscellaneous - fishing"}, DISTILLATE),
]

# Main-engine type, first match wins; "by rpm" and LNG are refined below.
BY_RPM = "by rpm"
ENGINE_RULES = [
    Rule({"code1": "NU"}, "Nuclear"),
    Rule({"code2": "NU"}, "Nuclear"),
    Rule({"code1": "ME"}, "Methanol"),
    Rule({"drive": STEAM_DRIVES}, "ST"),
    Rule({"drive": GAS_TURBINE_DRIVES}, "GT"),
    Rule({"drive": "AE"}, "Hydrogen"),
    Rule({"drive": "BE"}, "Electric"),
    Rule({"drive": SAIL_DRIVES}, "Sail"),
    Rule({"register_type": "Gas"}, "GT"),
    Rule({"register_type": "Turbine"}, "ST"),
    Rule({"register_type": "Reciprocatng"}, "Reciprocating"),
    Rule({"code1": "CU"}, "Reciprocating"),
    Rule({"code1": GAS_CODES}, LNG),
    Rule({"code2": GAS_CODES}, LNG),
    Rule({"fuel": LNG}, LNG),
    Rule({"drive": OIL_DRIVES}, BY_RPM),
    Rule({"fuel": (DISTILLATE, RESIDUAL)}, "SSD"),
]


REGISTER_COLUMNS = {
    "code1": "fp_fueltype1code",
    "code2": "fp_fueltype2code",
    "drive": "fp_propulsiontypecode",
    "imo_type": "vessel_type_imo_ghg",
    "register_type": "fp_me_enginetype",
    "fuel": "main_engine_fueltype",
}
ENGINE_BY_RPM = case(
    [("main_engine_rpm > 300 AND main_engine_rpm <= 900", "'MSD'"), ("main_engine_rpm > 900", "'HSD'")], "'SSD'"
)
# Kinds of gas engines, first match wins.
GAS_ENGINE = case(
    [
        ("lower(engine_model) LIKE '%df%' OR lower(engine_model) LIKE '%x%' OR lower(engine_model) LIKE '%me-ga%'",
         "'LNG-Otto SS'"),
        ("stroketype = 4 AND main_engine_rpm > 300", "'LNG-Otto MS'"),
        ("lower(engine_model) LIKE '%me%'", "'LNG-Diesel'"),
        ("fp_fueltype1code IN ('LG', 'GB', 'LP') AND fp_fueltype2code NOT IN ('DF', 'RF')", "'LBSI'"),
        (f"engine_builder IN ({', '.join(literal(name) for name in LEAN_BURN_BUILDERS)})", "'LBSI'"),
    ],
    "'LNG-Otto MS'",
)


def propulsion_code() -> Column:
    codes = ((f"fp_propulsiontype = {literal(name)}", literal(code)) for name, code in PROPULSION_CODES.items())
    return F.expr(case(codes, literal(config.UNKNOWN_FUEL_CODE)))


def fuel_type() -> Column:
    return F.expr(decide(FUEL_RULES, REGISTER_COLUMNS))


def engine_type() -> Column:
    refined = {BY_RPM: ENGINE_BY_RPM, LNG: GAS_ENGINE}
    return F.expr(decide(ENGINE_RULES, REGISTER_COLUMNS, lambda kind: refined.get(kind, literal(kind))))


# Band edges and labels.
YEAR_GROUPS = (
    (0, 1960, 1980, 1990, 2000, 2005, 2010, 2015, 2020),
    ("y1, <1959", "y2, 1960-1979", "y3, 1980-1989", "y4, 1990-1999", "y5, 2000-2004",
     "y6, 2005-2009", "y7, 2010-2014", "y8, 2015-2019", "y9, >=2020"),
)
LENGTH_GROUPS = (
    (0, 24, 50, 70, 100, 150, 225),
    ("l1, <24 m", "l2, 24-50 m", "l3, 50-70 m", "l4, 70-100 m", "l5, 100-150 m",
     "l6, 150-225 m", "l7, >=225 m"),
)
GT_GROUPS = (
    (0, 400, 1000, 3000, 5000, 10000, 25000, 50000, 100000),
    ("gt1, 0-399", "gt2, 400-999", "gt3, 1000-2999", "gt4, 3000-4999", "gt5, 5000-9999",
     "gt6, 10000-24999", "gt7, 25000-49999", "gt8, 50000-99999", "gt9, >=100 000"),
)
DWT_GROUPS = (
    (0, 5000, 10000, 25000, 50000, 75000, 100000, 150000, 200000),
    ("dwt1, <5000", "dwt2, 5 000-10 000", "dwt3, 10 000-25 000", "dwt4, 25 000-50 000",
     "dwt5, 50 000-75 000", "dwt6, 75 000-100 000", "dwt7, 100 000-150 000",
     "dwt8, 150 000-200 000", "dwt9, >=200 000"),
)
TIERS = ((1900, 2000, 2010, 2020), (0, 1, 2, 3))
NOX_TIERS = ((1900, 2000, 2011, 2021), (0, 1, 2, 3))


def size_and_age_bands() -> dict[str, Column]:
    texts = {
        "length_group": bands("length_overall", *LENGTH_GROUPS, config.UNKNOWN, above_first=True),
        "tier_group": bands("year_of_build", *TIERS, 0),
        "tier_group_nox": bands("year_of_build", *NOX_TIERS, config.UNKNOWN_NUMBER),
        "year_group": bands("year_of_build", *YEAR_GROUPS, config.UNKNOWN, above_first=True),
        "gt_group": bands("gt", *GT_GROUPS, config.UNKNOWN, above_first=True),
        "dwt_group": bands("dwt", *DWT_GROUPS, config.UNKNOWN, above_first=True),
    }
    return {name: F.expr(text) for name, text in texts.items()}


def first_engines(main_engines: DataFrame) -> DataFrame:
    """Builder and model of the engine in the lowest position of every ship.

    A position that is listed twice yields the lowest text, which settles what the
    delivered order leaves open.
    """
    def lowest_position(name: str) -> Column:
        return F.min(F.struct(F.col("Position"), F.col(name))).getField(name).alias(f"fp_{name}")

    return main_engines.groupBy(F.col("lrno").alias("fp_imo")).agg(
        lowest_position("enginebuilder"), lowest_position("enginemodel")
    )


def engine_register(ship_data: DataFrame, main_engines: DataFrame) -> DataFrame:
    """Current engine-register rows with their first main engine."""
    current = ship_data.filter(F.col("__END_AT").isNull()).select(
        F.col("lrimoshipno").alias("fp_imo"),
        F.col("fueltype1code").alias("fp_fueltype1code"),
        F.col("fueltype2code").alias("fp_fueltype2code"),
        F.col("MainEngineType").alias("fp_me_enginetype"),
        F.col("propulsiontype").alias("fp_propulsiontype"),
    )
    return current.join(first_engines(main_engines), "fp_imo", "left")


def primary_identities(identities: DataFrame, mmsi_limit: int | None = None) -> DataFrame:
    primary = identities.filter("row_number_mmsi_imo = 1")
    return primary.filter(F.col("mmsi") < mmsi_limit) if mmsi_limit else primary


def merge_registers(
    ships: DataFrame,
    identities: DataFrame,
    engines: DataFrame,
    battery_periods: DataFrame,
    vessel_types: DataFrame,
) -> DataFrame:
    """One row per vessel and battery period, missing values as sentinels."""
    known = primary_identities(identities, config.MMSI_LIMIT).select("vessel_id")
    battery = battery_periods.select(
        "vessel_id", "degree_of_electrification", F.col("start_date"), F.col("end_date")
    )
    classes = vessel_types.select("statcode5", F.col("vessel_type").alias("vessel_class"))
    merged = (
        ships.join(known, "vessel_id", "left_semi")
        .join(engines, F.col("fp_imo") == F.col("fairplay_id"), "left")
        .join(battery, "vessel_id", "left")
        .join(classes, "statcode5", "left")
    )

    def text(name: str, source: str | None = None, default: str = config.UNKNOWN) -> Column:
        return F.coalesce(F.col(source or name), F.lit(default)).alias(name)

    def number(name: str, *sources: str) -> Column:
        return F.coalesce(*(F.col(s) for s in sources or (name,)), F.lit(float(config.UNKNOWN_NUMBER))).alias(name)

    return merged.select(
        "vessel_id",
        "mmsi",
        "imo",
        text("call_sign"),
        text("ship_name"),
        text("flag_code"),
        text("vessel_type_imo_ghg"),
        text("vessel_class"),
        text("statcode5"),
        number("year_of_build"),
        number("gt"),
        number("dwt"),
        number("teu"),
        number("cbm", "liquid_capacity", "gas_capacity"),
        number("length_overall"),
        number("breadth_moulded"),
        number("draught"),
        text("ship_type"),
        number("main_engine_rpm"),
        number("main_engine_kw", "power_kw_max"),
        number("stroketype", "main_engine_stroke_type"),
        number("speed_service"),
        number("speed_max"),
        number("power_kw_max"),
        text("fp_fueltype1code", default=config.UNKNOWN_FUEL_CODE),
        text("fp_fueltype2code", default=config.UNKNOWN_FUEL_CODE),
        text("fp_me_enginetype"),
        text("fp_propulsiontype"),
        text("engine_builder", "fp_enginebuilder"),
        text("engine_model", "fp_enginemodel"),
        F.coalesce("degree_of_electrification", F.lit(0.0)).alias("degree_of_electrification"),
        F.coalesce("start_date", F.lit(config.FIRST_DATE).cast("date")).alias("start_date"),
        F.coalesce("end_date", F.lit(config.LAST_DATE).cast("date")).alias("end_date"),
    )


def peer_fuels(vessels: DataFrame) -> DataFrame:
    """Most frequent fuel by class and size, by size and by class, one row per class and size.

    Counts per (class, size, fuel) are at most a few thousand rows, whatever the
    number of vessels. The windows run over those, so none ever collects the
    vessels of a class. Ties go to the alphabetically first fuel.
    """
    counts = vessels.groupBy("vessel_class", "gt_group", F.col("main_engine_fueltype").alias("fuel")).agg(
        F.count("*").alias("n")
    )
    groups = {"_by_both": ["vessel_class", "gt_group"], "_by_size": ["gt_group"], "_by_class": ["vessel_class"]}
    totals = counts.withColumns(
        {f"n{name}": F.sum("n").over(Window.partitionBy(*keys, "fuel")) for name, keys in groups.items()}
    )
    unknown_last = F.col("fuel").isNull()
    modes = {
        name: F.first("fuel").over(Window.partitionBy(*keys).orderBy(unknown_last, F.desc(f"n{name}"), "fuel"))
        for name, keys in groups.items()
    }
    return totals.withColumns(modes).groupBy("vessel_class", "gt_group").agg(
        *(F.any_value(name).alias(name) for name in groups)
    )


def impute_fuel(vessels: DataFrame) -> DataFrame:
    """Fill unknown fuels with the most frequent one of class and size, else size, else class."""
    peers = peer_fuels(vessels)
    filled = vessels.withColumn("main_engine_fueltype_original", F.col("main_engine_fueltype")).join(
        peers, ["vessel_class", "gt_group"], "left"
    )
    names = ("_by_both", "_by_size", "_by_class")
    return filled.withColumn("main_engine_fueltype", F.coalesce("main_engine_fueltype", *names)).drop(*names)


def default_electrification() -> Column:
    """0.95 for electric ships without a value.

    Missing degrees are already 0 at this point, so the default never applies;
    kept because results must stay as they are.
    """
    degree = F.col("degree_of_electrification")
    return F.when((F.col("main_engine_fueltype") == ELECTRIC) & degree.isNull(), F.lit(0.95)).otherwise(degree)


def corrected_power() -> Column:
    """Registered speeds of cruise ships belong to less than full load."""
    power = F.col("main_engine_kw")
    return F.when(F.col("vessel_class") == "Cruise", power * 0.7).otherwise(power)


VESSEL_COLUMNS = (
    "vessel_id", "start_date", "end_date", "mmsi", "imo", "call_sign", "ship_name", "flag_code",
    "vessel_type_imo_ghg", "vessel_class", "statcode5", "year_of_build", *config.SIZE_UNITS,
    "length_overall", "breadth_moulded", "draught", "ship_type", "main_engine_rpm",
    "main_engine_kw", "stroketype", "speed_service", "speed_max", "power_kw_max",
    "fp_fueltype1code", "fp_fueltype2code", "fp_me_enginetype", "fp_propulsiontype",
    "engine_builder", "engine_model", "degree_of_electrification", *POWER_COLUMNS,
    "length_group", "tier_group", "tier_group_nox", "year_group", "gt_group", "dwt_group",
    "fp_propulsiontypecode", "main_engine_fueltype", "main_engine_fueltype_original",
    "main_engine_enginetype",
)


def classify(vessels: DataFrame) -> DataFrame:
    """Bands, propulsion, fuel (with imputation), engine type and power correction, in this order."""
    coded = vessels.withColumns({**size_and_age_bands(), "fp_propulsiontypecode": propulsion_code()})
    fuelled = impute_fuel(coded.withColumn("main_engine_fueltype", fuel_type()))
    return fuelled.withColumns(
        {
            "main_engine_enginetype": engine_type(),
            "degree_of_electrification": default_electrification(),
            "main_engine_kw": corrected_power(),
        }
    )


def build_vessel_dimension(merged: DataFrame, bins: DataFrame) -> DataFrame:
    """Register rows with a size bin, classified; vessels of unknown type drop out."""
    sized = merged.join(match_size_bins(merged, bins), ["vessel_id", "start_date"], "inner")
    return classify(sized).select(*VESSEL_COLUMNS)


def eligible_vessels(vessels: DataFrame) -> DataFrame:
    """Vessels with a model class; only these get emissions."""
    return vessels.filter(~F.coalesce("vessel_class", F.lit("")).isin("", config.UNKNOWN))


def current_vessels(vessels: DataFrame, today: Column | None = None) -> DataFrame:
    """The rows still open today, without their interval."""
    day = F.current_date() if today is None else today
    return vessels.filter(F.col("end_date") > day).drop("start_date", "end_date")


def row_counts(ships: DataFrame, identities: DataFrame, battery: DataFrame, vessels: DataFrame) -> DataFrame:
    """Vessel periods expected (ships of known type and their battery periods) and found, as one row."""
    known = primary_identities(identities, config.MMSI_LIMIT).select("vessel_id")
    expected = (
        ships.filter(F.col("vessel_type_imo_ghg").isNotNull())
        .join(known, "vessel_id", "left_semi")
        .join(battery.select("vessel_id"), "vessel_id", "left")
        .select(F.lit("expected").alias("side"))
    )
    both = expected.unionAll(vessels.select(F.lit("actual").alias("side")))
    return both.agg(
        F.count_if(F.col("side") == "expected").alias("expected_rows"),
        F.count_if(F.col("side") == "actual").alias("actual_rows"),
    )


def check_row_counts(ships: DataFrame, identities: DataFrame, battery: DataFrame, vessels: DataFrame) -> None:
    row = row_counts(ships, identities, battery, vessels).first()
    if row["expected_rows"] != row["actual_rows"]:
        raise AssertionError(f"expected {row['expected_rows']} vessel periods, found {row['actual_rows']}")
