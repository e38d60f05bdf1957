"""Versioned emission parameters: as-of choice, required names and literals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipflux.functions.keyed import keep_first
from shipflux.functions.rules import literal

# Parameter names are built from these parts.
SLUG = {"Residual Fuel": "residual_fuel", "Distillate Fuel": "distillate_fuel", "LNG": "lng"}
FUEL_SLUGS = ("residual_fuel", "distillate_fuel", "lng")
LNG_ENGINE_SLUGS = {
    "LNG-Otto SS": "lng_otto_ss",
    "LNG-Otto MS": "lng_otto_ms",
    "LBSI": "lng_lbsi",
    "LNG-Diesel": "lng_diesel",
}
THREE_YEAR_BANDS = ("year_0_1983", "year_1984_2000", "year_2001_2999")
TWO_YEAR_BANDS = ("year_0_2000", "year_2001_2999")
LOW_LOAD_EDGES = (0.0001, *(step / 100 for step in range(2, 20)))
LOW_LOAD_POLLUTANTS = ("pm10", "nox", "co", "ch4", "nmvoc", "n2o")


def low_load_bin_names() -> list[str]:
    """'00001_002', '002_003', ... '009_01', '01_011', ... '018_019'."""
    text = [str(edge).replace(".", "") for edge in LOW_LOAD_EDGES]
    return [f"{low}_{high}" for low, high in zip(text, text[1:])]


def required_names() -> list[str]:
    """Every parameter the model reads, 323 in all, in alphabetical order."""
    main = "main_engine"
    names: set[str] = set()

    for pollutant in ("bc", "ch4", "co", "n2o", "nmvoc", "nox"):
        names |= {f"{pollutant}_{engine}_{fuel}" for engine in ("aux", "boiler") for fuel in FUEL_SLUGS}

    for pollutant in ("ch4", "co", "n2o", "nmvoc", "nox"):
        names |= {f"{pollutant}_{main}_{turbine}{end}" for turbine in ("gt", "st") for end in ("", "_lng")}
    for pollutant in ("ch4", "co", "n2o", "nmvoc"):
        names |= {f"{pollutant}_{main}_{slug}" for slug in LNG_ENGINE_SLUGS.values()}
    for pollutant in ("co", "n2o"):
        names |= {
            f"{pollutant}_{main}_{diesel}_{fuel}"
            for diesel in ("ssd", "msd", "hsd")
            for fuel in ("residual_fuel", "distillate_fuel")
        }
        names |= {f"{pollutant}_{main}_{turbine}_distillate_fuel" for turbine in ("gt", "st")}
    names |= {f"{pollutant}_{main}_methanol" for pollutant in ("ch4", "co", "n2o")}
    names |= {f"{pollutant}_{main}_{diesel}" for pollutant in ("ch4", "nmvoc") for diesel in ("ssd", "msd", "hsd")}
    names |= {f"nmvoc_{main}_{diesel}_methanol" for diesel in ("ssd", "msd")}

    names |= {f"nox_{main}_{slug}" for slug in ("lng_otto_ss", "lng_otto_ms", "lng_lbsi")}
    names |= {f"nox_{main}_tier_{tier}_{kind}" for tier in range(4) for kind in ("ssd", "msd", "hsd", "lng_diesel")}
    names |= {f"nox_{main}_tier_{tier}_rpm_{band}" for tier in (1, 2, 3) for band in ("1_129", "2000_")}

    names |= {f"bc_{main}_{slug}" for slug in LNG_ENGINE_SLUGS.values()}
    names |= {f"bc_{main}_{kind}" for kind in ("lng_gt", "lng_st", "residual_fuel_gt", "residual_fuel_st")}

    names |= {f"cf_{fuel}" for fuel in (*FUEL_SLUGS, "methanol", "other")}
    names |= {f"fuel_equivalent_{fuel}" for fuel in ("hfo", "mdo", "lng", "methanol")}
    names |= {f"fuel_sulfur_fraction_{kind}" for kind in ("global_distillate_fuel", "global_residual_fuel", "global", "eca")}
    names |= {f"co2e_gwp100_{gas}" for gas in ("co2", "ch4", "n2o")}
    names.add("pm_2_5")
    for engine in (main, "aux", "boiler"):
        names |= {f"pm_{engine}_lng_{kind}" for kind in ("otto_ss", "otto_ms", "lbsi", "gt", "st")}
        names |= {f"sox_{engine}_{fuel}" for fuel in ("lng", "methanol")}

    names |= {
        f"sfc_{main}_{fuel}_{diesel}_{band}"
        for fuel in ("distillate_fuel", "residual_fuel")
        for diesel in ("ssd", "msd", "hsd")
        for band in THREE_YEAR_BANDS
    }
    names |= {f"sfc_{main}_{fuel}_{turbine}" for fuel in FUEL_SLUGS for turbine in ("gt", "st")}
    names |= {f"sfc_{main}_methanol_{diesel}" for diesel in ("ssd", "msd")}
    names |= {f"sfc_{main}_{kind}_{band}" for kind in ("lng_otto_ms", "lng_lbsi") for band in TWO_YEAR_BANDS}
    for kind in ("lng_diesel", "lng_otto_ss"):
        names |= {f"sfc_{main}_{kind}_year_2001_2999{end}" for end in ("", "_pilot_fuel")}
    names |= {f"sfc_aux_{fuel}_{band}" for fuel in ("distillate_fuel", "residual_fuel") for band in THREE_YEAR_BANDS}
    names |= {f"sfc_aux_lng_{band}" for band in TWO_YEAR_BANDS}
    names |= {f"sfc_boiler_{fuel}" for fuel in FUEL_SLUGS}

    names |= {f"low_load_{gas}_{main}_{span}" for gas in LOW_LOAD_POLLUTANTS for span in low_load_bin_names()}
    return sorted(names)


def variables_as_of(variables: DataFrame, as_of: str) -> DataFrame:
    """The current version of every variable that is valid on a date.

    Of several valid periods the one that starts last wins; the rest of the order
    only settles ties that the delivered data leaves open.
    """
    day = F.lit(as_of).cast("date")
    valid = variables.filter(
        F.col("__END_AT").isNull()
        & (F.col("start_date") <= day)
        & (F.col("end_date").isNull() | (F.col("end_date") >= day))
    )
    order = [
        F.col("start_date").desc(),
        F.col("end_date").desc_nulls_first(),
        F.col("value").asc_nulls_first(),
    ]
    return keep_first(valid, ["variable"], order)


class Parameters(Mapping[str, str]):
    """Parameter values as SQL literals, so Catalyst folds them into the generated code."""

    def __init__(self, values: Mapping[str, float | None]):
        missing = [name for name in required_names() if name not in values]
        if missing:
            raise KeyError(f"{len(missing)} emission parameters are missing: {', '.join(missing)}")
        self._values = dict(values)

    @classmethod
    def load(cls, current: DataFrame) -> Parameters:
        """Fetch the required names only: at most 323 rows, whatever the table holds."""
        wanted = current.filter(F.col("variable").isin(required_names())).select("variable", "value")
        return cls({row["variable"]: row["value"] for row in wanted.collect()})

    def __getitem__(self, name: str) -> str:
        value = self._values[name]
        return "CAST(NULL AS DOUBLE)" if value is None else literal(float(value))

    def column(self, name: str) -> Column:
        return F.expr(self[name])

    def __iter__(self):
        return iter(self._values)

    def __len__(self) -> int:
        return len(self._values)


def missing_names(variables: DataFrame, names: Iterable[str]) -> DataFrame:
    """Required names that a parameter table does not hold, as rows."""
    spark = variables.sparkSession
    wanted = spark.createDataFrame([(name,) for name in names], "variable string")
    return wanted.join(variables.select("variable").distinct(), "variable", "left_anti")
