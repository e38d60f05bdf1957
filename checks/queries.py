"""Every operator as a query over inputs derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.spark_inputs import derive, given, positions, stored
from shipflux import config
from shipflux.functions.cells import parent_cell
from shipflux.functions.cleaning import clear_null_words
from shipflux.operators import (
    areas,
    electrification,
    emissions,
    energy,
    factors,
    fuel,
    incremental,
    parameters,
    register,
    report,
    shore_power,
    size_bins,
    voyages,
)
from shipflux.plans import jobs, points, views
from shipflux.plans import register as register_plan
from shipflux.session import work_folder
from shipflux.sources.tables import positions_between
from shipflux.streaming import scd

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

_lookups: dict[tuple[str, str], points.Lookups] = {}

# Fixed "today", date range of the scans by date, and current month of the views: later months are in the data.
TODAY = "2024-06-01"
FIRST, LAST = "1997-03-01", "1999-11-30"
THIS_MONTH = "1998-03"
STAMP = "2024-06-01 12:00:00"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def day(text: str) -> Column:
    return F.lit(text).cast("date")


def steady(name: str, places: int = 6) -> Column:
    """A double cut to a number of places, off any round value, so that the last bits cannot matter."""
    scale = 10.0**places
    return (F.floor(F.col(name) * scale + 0.31371828459) / scale).alias(name)


def text(name: str) -> Column:
    return F.col(name).cast("string").alias(name)


def moment(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def doubles(names: Iterable[str], places: int = 6) -> list[Column]:
    return [steady(name, places) for name in names]


# ---------------------------------------------------------------- inputs of the jobs


def values_of(spark: SparkSession, sf_dir: str) -> parameters.Parameters:
    return parameters.Parameters.load(derive(spark, sf_dir, "parameter_values"))


def battery_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        silver = electrification.clean_battery(given(spark, sf_dir, "battery_raw"))
        return electrification.battery_periods(silver, given(spark, sf_dir, "identities"))

    return stored(spark, sf_dir, "battery", build)


def bins_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "bins", lambda: size_bins.build_size_bins(given(spark, sf_dir, "bins_raw"))
    )


def towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "municipalities")
    return electrification.municipalities_of_year(rows, config.MUNICIPALITY_YEAR)


def report_towns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return towns(spark, sf_dir).select("municipality_no", F.col("municipality_name_no").alias("municipality_name"))


def report_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return given(spark, sf_dir, "counties").filter(F.col("year") == config.MUNICIPALITY_YEAR)


def register_inputs(spark: SparkSession, sf_dir: str) -> register_plan.RegisterInputs:
    names = ("ships", "identities", "ship_data", "main_engines")
    return register_plan.RegisterInputs(
        *(given(spark, sf_dir, name) for name in names),
        battery_table(spark, sf_dir),
        given(spark, sf_dir, "vessel_types"),
        bins_table(spark, sf_dir),
    )


def vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(
        spark, sf_dir, "vessels", lambda: register_plan.vessel_dimension(register_inputs(spark, sf_dir))
    )


def eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register.eligible_vessels(vessels(spark, sf_dir))


def layer_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    sources = ("layer_eca", "layer_plan", "layer_zone", "layer_shelf", "layer_town")
    return {layer.name: given(spark, sf_dir, name) for layer, name in zip(areas.LAYERS, sources)}


def vessel_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        silver = electrification.clean_vessel_port(given(spark, sf_dir, "vessel_port_raw"))
        return electrification.vessel_port_usage(silver, given(spark, sf_dir, "identities"), towns(spark, sf_dir))

    return stored(spark, sf_dir, "vessel_usage", build)


def type_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build() -> DataFrame:
        silver = electrification.clean_type_port(given(spark, sf_dir, "type_port_raw"))
        return electrification.type_port_usage(silver, given(spark, sf_dir, "vessel_types"), towns(spark, sf_dir))

    return stored(spark, sf_dir, "type_usage", build)


def fact_inputs(spark: SparkSession, sf_dir: str) -> points.FactInputs:
    return points.FactInputs(
        vessels(spark, sf_dir),
        layer_tables(spark, sf_dir),
        given(spark, sf_dir, "installations"),
        electrification.close_open_periods(vessel_usage(spark, sf_dir), day(TODAY)),
        electrification.close_open_periods(type_usage(spark, sf_dir), day(TODAY)),
        values_of(spark, sf_dir),
    )


def lookups(spark: SparkSession, sf_dir: str) -> points.Lookups:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _lookups:
        built = points.build_lookups(fact_inputs(spark, sf_dir))
        _lookups[key] = points.store_lookups(built, work_folder(spark, "lookups"))
    return _lookups[key]


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit(STAMP).cast("timestamp")
    return points.emission_facts(positions(spark, sf_dir), lookups(spark, sf_dir), stamp=stamp)


def report_inputs(spark: SparkSession, sf_dir: str) -> jobs.ReportInputs:
    return jobs.ReportInputs(
        vessels(spark, sf_dir),
        given(spark, sf_dir, "ship_names"),
        report_towns(spark, sf_dir),
        report_counties(spark, sf_dir),
        given(spark, sf_dir, "layer_zone"),
        given(spark, sf_dir, "layer_plan"),
    )


def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.lit(STAMP).cast("timestamp")
    rows = positions(spark, sf_dir)
    return jobs.report_positions(rows, rows, lookups(spark, sf_dir), report_inputs(spark, sf_dir), stamp=stamp)


def written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as a table, with an older version of it beside."""
    report_rows = stored(spark, sf_dir, "report", lambda: full_report(spark, sf_dir), beside=jobs.REPORT_STAGES)
    return report_rows.union(report_rows.withColumn("version", F.lit("v0.9")).select(report_rows.columns))


# ---------------------------------------------------------------- scans, cleaning, parameters


@query
def ais_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions_between(positions(spark, sf_dir), FIRST, LAST)
    return rows.select(
        "id", "vessel_id", "mmsi", moment("date_time_utc"), "hex_14", "hex_7", "hex_9", "sail_id", "phase",
        steady("speed_over_ground"), "voyage_type", "in_coast_and_sea_area", "ship_is_stopped",
    )


@query
def cell_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = positions(spark, sf_dir).select("hex_14").distinct()
    return cells.select("hex_14", *(parent_cell(F.col("hex_14"), r).alias(f"parent_{r}") for r in (0, 5, 7, 9, 13)))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.type_variables(derive(spark, sf_dir, "deliveries"))


VARIABLE_KEYS = ["variable", "start_date"]
SEQUENCE = "bi_ingested_timestamp"


@query
def typed_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deliveries(spark, sf_dir).select(
        "variable", "value", text("start_date"), text("end_date"), moment(SEQUENCE)
    )


@query
def null_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = given(spark, sf_dir, "battery_raw")
    return clear_null_words(rows, "route", "vessel_name").fillna(0, subset=["imo"]).select(
        "mmsi", "imo", "vessel_name", "route", text("start_date")
    )


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd.scd2(deliveries(spark, sf_dir), VARIABLE_KEYS, SEQUENCE)


@query
def scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions(spark, sf_dir).select(
        "variable", text("start_date"), text("end_date"), "value", moment("__START_AT"), moment("__END_AT")
    )


@query
def scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = scd.scd1(deliveries(spark, sf_dir), ["variable"], SEQUENCE)
    return latest.select("variable", text("start_date"), text("end_date"), "value", moment(SEQUENCE))


@query
def variables_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = parameters.variables_as_of(versions(spark, sf_dir), "1998-05-01")
    return current.select("variable", "value", text("start_date"), text("end_date"))


# ---------------------------------------------------------------- register


@query
def dedup_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = electrification.clean_battery(given(spark, sf_dir, "battery_raw"))
    return silver.select(
        "mmsi", "imo", "vessel_name", "route", "degree_of_electrification", "battery_pack_kwh",
        text("start_date"), text("end_date"),
    )


@query
def battery_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = electrification.clean_battery(given(spark, sf_dir, "battery_raw"))
    periods = electrification.battery_periods(silver, given(spark, sf_dir, "identities"))
    return periods.select(
        "vessel_id", "mmsi", "imo", "degree_of_electrification", "battery_pack_kwh",
        text("start_date"), text("end_date"),
    )


@query
def identity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    primary = register.primary_identities(given(spark, sf_dir, "identities"))
    raw = given(spark, sf_dir, "vessel_port_raw")
    return primary.join(raw, ["imo", "mmsi"], "inner").select(
        "vessel_id", "imo", "mmsi", "municipality_name", text("start_date")
    )


@query
def vessel_port_electric(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = electrification.clean_vessel_port(given(spark, sf_dir, "vessel_port_raw"))
    usage = electrification.vessel_port_usage(silver, given(spark, sf_dir, "identities"), towns(spark, sf_dir))
    return usage.select(
        "vessel_id", "mmsi", "imo", "municipality_no", "municipality_name", "usage_percentage",
        text("start_date"), text("end_date"),
    )


def type_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return electrification.clean_type_port(given(spark, sf_dir, "type_port_raw"))


@query
def type_port_electric(spark: SparkSession, sf_dir: str) -> DataFrame:
    usage = electrification.type_port_usage(
        type_silver(spark, sf_dir), given(spark, sf_dir, "vessel_types"), towns(spark, sf_dir)
    )
    return usage.select(
        "vessel_type", "municipality_no", "municipality_name", "usage_percentage",
        text("start_date"), text("end_date"),
    )


@query
def name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = given(spark, sf_dir, "vessel_types").select("vessel_type").distinct()
    rows = given(spark, sf_dir, "type_port_raw").join(towns(spark, sf_dir), "municipality_name", "inner")
    return rows.join(types, "vessel_type", "inner").select(
        "vessel_type", "municipality_name", "municipality_no", text("start_date")
    )


@query
def unmatched_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = type_silver(spark, sf_dir)
    types = electrification.unmatched(silver, given(spark, sf_dir, "vessel_types"), "vessel_type")
    places = electrification.unmatched(silver, towns(spark, sf_dir), "municipality_name")
    return types.select(F.lit("vessel_type").alias("kind"), F.col("vessel_type").alias("name")).unionAll(
        places.select(F.lit("municipality_name").alias("kind"), F.col("municipality_name").alias("name"))
    )


@query
def engine_first_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register.engine_register(given(spark, sf_dir, "ship_data"), given(spark, sf_dir, "main_engines"))


BIN_COLUMNS = (
    "vessel_type", "vessel_type_id", "unit", "low_limit", "high_limit", "size_bin", *size_bins.POWER_COLUMNS,
)


@query
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = size_bins.latest_batch(given(spark, sf_dir, "bins_raw"))
    return rows.select("vessel_type", "size_bin", "unit", "low_limit", "aux_berth", moment(SEQUENCE))


@query
def open_top_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = size_bins.open_top_bin(size_bins.latest_batch(given(spark, sf_dir, "bins_raw")))
    return rows.select("vessel_type", "size_bin", "low_limit", "high_limit")


@query
def unknown_bin(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = size_bins.unknown_bins(size_bins.latest_batch(given(spark, sf_dir, "bins_raw")))
    return rows.select("vessel_type", "vessel_type_id", "unit", "low_limit", "high_limit", "size_bin")


@query
def size_bins_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = size_bins.build_size_bins(given(spark, sf_dir, "bins_raw"))
    return rows.select(*BIN_COLUMNS[:6], *(F.col(name).cast("double") for name in size_bins.POWER_COLUMNS))


QUERIES["size_bins"] = QUERIES.pop("size_bins_table")


@query
def register_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = register_plan.merged_register(register_inputs(spark, sf_dir))
    return merged.withColumns(
        {"mmsi": F.array_join("mmsi", ","), "start_date": text("start_date"), "end_date": text("end_date")}
    )


@query
def unpivot_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = register_plan.merged_register(register_inputs(spark, sf_dir))
    return size_bins.unpivot_sizes(merged).withColumn("start_date", text("start_date"))


@query
def size_bin_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = register_plan.merged_register(register_inputs(spark, sf_dir))
    matched = size_bins.match_size_bins(merged, bins_table(spark, sf_dir))
    return matched.select(
        "vessel_id", text("start_date"), *(F.col(name).cast("double") for name in size_bins.POWER_COLUMNS)
    )


@query
def keep_first_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubled = bins_table(spark, sf_dir).unionByName(
        bins_table(spark, sf_dir).withColumn("low_limit", F.col("low_limit") + 5)
    )
    return size_bins.unique_bins(doubled).select("vessel_type", "size_bin", "low_limit", "high_limit", "unit")


QUERIES["keep_first"] = QUERIES.pop("keep_first_bins")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return register_plan.vessel_dimension(register_inputs(spark, sf_dir))


@query
def vessel_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    powers = {name: F.col(name).cast("double") for name in size_bins.POWER_COLUMNS}
    return dimension(spark, sf_dir).withColumns(
        {
            **powers,
            "mmsi": F.array_join("mmsi", ","),
            "start_date": text("start_date"),
            "end_date": text("end_date"),
            "main_engine_kw": steady("main_engine_kw"),
        }
    )


def dimension_part(*names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dimension(spark, sf_dir).select("vessel_id", text("start_date"), *names)

    return run


QUERIES["propulsion_code"] = dimension_part("fp_propulsiontype", "fp_propulsiontypecode")
QUERIES["fuel_type"] = dimension_part(
    "fp_fueltype1code", "fp_fueltype2code", "fp_propulsiontypecode", "main_engine_fueltype_original"
)
QUERIES["mode_impute"] = dimension_part(
    "vessel_class", "gt_group", "main_engine_fueltype_original", "main_engine_fueltype"
)
QUERIES["engine_type"] = dimension_part("main_engine_rpm", "stroketype", "engine_model", "main_engine_enginetype")
QUERIES["banding"] = dimension_part(
    "year_of_build", "length_group", "tier_group", "tier_group_nox", "year_group", "gt_group", "dwt_group"
)


@query
def speed_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension(spark, sf_dir).select("vessel_id", text("start_date"), "vessel_class", steady("main_engine_kw"))


@query
def vessel_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = register.current_vessels(vessels(spark, sf_dir), day("1999-06-01"))
    return current.select("vessel_id", "ship_name", "vessel_class", "degree_of_electrification", "gt_group")


@query
def vessel_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible(spark, sf_dir).select("vessel_id", text("start_date"), "vessel_class")


@query
def qc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = register_inputs(spark, sf_dir)
    return register.row_counts(inputs.ships, inputs.identities, inputs.battery, dimension(spark, sf_dir))


# ---------------------------------------------------------------- factors and consumption baselines


def named_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factors.with_named_factors(eligible(spark, sf_dir), values_of(spark, sf_dir))


def factor_query(*names: str, plain: tuple[str, ...] = ()) -> Query:
    columns = [*plain, *(f"{name}_{area}" for name in names for area in factors.AREAS)]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return named_factors(spark, sf_dir).select(
            "vessel_id", text("start_date"), "main_engine_fueltype", "main_engine_enginetype",
            *doubles(columns, 9),
        )

    return run


def per_engine(pollutant: str) -> list[str]:
    return [f"{pollutant}_{engine}" for engine in config.ENGINES]


QUERIES["ef_co2"] = factor_query("cf")
for _name in ("ch4", "co", "n2o", "nmvoc", "nox"):
    QUERIES[f"ef_{_name}"] = factor_query(*per_engine(_name))
QUERIES["ef_bc"] = factor_query(
    "bc_main_engine_coefficient", "bc_main_engine_exponent", "bc_main_engine_flat", "bc_aux", "bc_boiler"
)
QUERIES["ef_sox_pm"] = factor_query(
    "fuel_sulfur_fraction", *per_engine("sox"), "pm_main_engine_base", "pm_main_engine_slope", "pm_aux", "pm_boiler"
)
QUERIES["sfc_main"] = factor_query(plain=("sfc_main_engine_baseline", "sfc_pilot_fuel"))
QUERIES["sfc_aux_boiler"] = factor_query(plain=("sfc_aux", "sfc_boiler"))


# ---------------------------------------------------------------- positions


@query
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = points.interval_join(positions(spark, sf_dir), eligible(spark, sf_dir))
    return joined.select("id", "vessel_id", "mmsi", moment("date_time_utc"), text("period_start"))


def one_per_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(spark, sf_dir).select(*points.POINT_COLUMNS)
    return points.one_per_time(points.interval_join(rows, eligible(spark, sf_dir)))


@query
def point_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_time(spark, sf_dir).select("id", "mmsi", moment("date_time_utc"), text("period_start"))


LAYER_COLUMNS = (
    "emission_control_area_id", "management_plan_marine_areas_area_id",
    "management_plan_marine_areas_area_name_norwegian", "maritime_borders_norwegian_economic_zone_id",
    "maritime_borders_norwegian_economic_zone_area_name", "maritime_borders_norwegian_continental_shelf_id",
    "municipality_id", "municipality_name",
)


@query
def area_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = {
        layer.name: areas.read_layer(layer_tables(spark, sf_dir)[layer.name], layer) for layer in areas.LAYERS
    }
    towns_read, zones_read = read["municipality"], read["maritime_borders_norwegian_economic_zone"]
    return towns_read.join(zones_read, "hex_9", "inner")


@query
def cell_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = areas.with_parent_cells(positions(spark, sf_dir))
    joined = areas.join_cells(rows, areas.cell_lookups(layer_tables(spark, sf_dir)))
    return joined.select("id", moment("date_time_utc"), *LAYER_COLUMNS)


@query
def kring_nearest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = areas.with_parent_cells(positions(spark, sf_dir))
    joined = areas.join_shore_power(rows, areas.nearest_shore_power(given(spark, sf_dir, "installations")))
    return joined.select(
        "id", moment("date_time_utc"), "shore_power_id", steady("shore_power_usage_percentage"),
        "shore_power_hex_kring_distance_9_1",
    )


@query
def area_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points.locate(positions(spark, sf_dir), lookups(spark, sf_dir))
    return rows.select(
        "id", moment("date_time_utc"), "dist_to_power", "close_to_power", "eca", "in_management_planning_area",
        "in_norwegian_continental_shelf",
    )


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.enrich(positions(spark, sf_dir), lookups(spark, sf_dir))


@query
def port_electric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select(
        "mmsi", moment("date_time_utc"), "municipality_id", "vessel_class",
        "usage_percentage_vessel_port_electric", "usage_percentage_vessel_type_port_electric",
    )


def powered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions with vessel attributes but without areas: what the energy operators need."""
    return energy.with_energy(
        points.attach_vessels(one_per_time(spark, sf_dir), lookups(spark, sf_dir).factors)
    )


def energy_query(*names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return powered(spark, sf_dir).select("mmsi", moment("date_time_utc"), *doubles(names))

    return run


QUERIES["load_factor"] = energy_query("main_engine_load_factor")
QUERIES["main_kwh"] = energy_query("main_engine_kwh")
QUERIES["aux_boiler_kwh"] = energy_query("aux_kwh", "boiler_kwh")


@query
def low_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = values_of(spark, sf_dir)
    binned = powered(spark, sf_dir).withColumn("low_load_bin", emissions.low_load_bin())
    multipliers = {
        f"{name}_low_load_factor": emissions.low_load_multiplier(values, name)
        for name in parameters.LOW_LOAD_POLLUTANTS
    }
    return binned.withColumns(multipliers).select("mmsi", moment("date_time_utc"), *doubles(multipliers))


@query
def sfc_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = powered(spark, sf_dir).withColumn("sfc_main_engine", fuel.main_engine_sfc())
    return rows.select(
        "mmsi", moment("date_time_utc"), *doubles(("sfc_main_engine", "sfc_aux", "sfc_boiler"))
    )


def consumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.consume(enriched(spark, sf_dir))


@query
def shore_power_at_berth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shore_power.with_shore_power(enriched(spark, sf_dir)).select(
        "mmsi", moment("date_time_utc"), "electric_shore_power_at_berth",
        "electric_shore_power_at_berth_reduction_factor", "phase",
    )


QUERIES["shore_power"] = QUERIES.pop("shore_power_at_berth")


@query
def fuel_tonnes(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"{engine}_fuel_tonnes" for engine in config.ENGINES]
    return consumed(spark, sf_dir).select("mmsi", moment("date_time_utc"), *doubles((*names, "fuel_tonnes"), 9))


@query
def fuel_equivalent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumed(spark, sf_dir).select(
        "mmsi", moment("date_time_utc"), *doubles(("fuel_mdo_equivalent_tonnes",), 9)
    )


def emitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return points.emit(consumed(spark, sf_dir), values_of(spark, sf_dir))


def emission_query(*names: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return emitted(spark, sf_dir).select("mmsi", moment("date_time_utc"), *doubles(names, 9))

    return run


def engine_columns(pollutant: str) -> list[str]:
    return [f"{pollutant}_{engine}_tonnes" for engine in config.ENGINES]


for _name in ("bc", "ch4", "co", "co2", "n2o", "nmvoc", "nox", "sox"):
    QUERIES[f"emission_{_name}"] = emission_query(*engine_columns(_name))
QUERIES["emission_pm"] = emission_query(*engine_columns("pm10"), "pm2_5_tonnes")
QUERIES["emission_total"] = emission_query(*(f"{name}_tonnes" for name in config.POLLUTANTS), "fuel_tonnes")
QUERIES["emission_co2e"] = emission_query("co2e_tonnes")


FACT_DOUBLES = (
    "main_engine_load_factor", "main_engine_kwh", "aux_kwh", "boiler_kwh", "fuel_tonnes",
    "fuel_mdo_equivalent_tonnes", *(f"{gas}_tonnes" for gas in report.GASES), "distance_previous_point_meters",
)


@query
def point_emission(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = facts(spark, sf_dir)
    steadied = {name: steady(name) for name in FACT_DOUBLES}
    return rows.withColumns(
        {
            **steadied,
            "date_time_utc": moment("date_time_utc"),
            "bi_processing_time": moment("bi_processing_time"),
        }
    )


# ---------------------------------------------------------------- report


@query
def fact_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.report_facts(facts(spark, sf_dir), config.VERSION, FIRST, LAST)
    return rows.select(
        "mmsi", moment("date_time_utc"), "year", "county_id", *doubles(("aux_kwh_shore_power", "boiler_kwh_shore_power")),
        "in_norwegian_continental_shelf", "version",
    )


def voyage_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.join_voyages(
        report.report_facts(facts(spark, sf_dir), config.VERSION),
        report.report_voyages(positions(spark, sf_dir)),
    )


@query
def fact_voyage_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voyage_facts(spark, sf_dir).select(
        "mmsi", moment("date_time_utc"), "voyage_type", "ship_is_stopped", "municipality_id", "unlocode_country_code",
        *doubles(("co2_tonnes", "distance_previous_point_meters")),
    )


def voyage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions in their municipality, without the fact calculation."""
    town = next(layer for layer in areas.LAYERS if layer.name == "municipality")
    lookups = areas.cell_lookups({town.name: given(spark, sf_dir, "layer_town")})
    located = areas.join_cells(areas.with_parent_cells(positions(spark, sf_dir)), lookups)
    rows = located.drop("municipality_name")
    ends = voyages.voyage_ends(voyages.voyage_parts(rows))
    return voyages.with_voyages(rows, ends, report_towns(spark, sf_dir))


@query
def voyage_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voyage_rows(spark, sf_dir).select(
        "id", moment("date_time_utc"), "sail_id", "municipality_id", "municipality_id_start", "municipality_id_end",
        "municipality_voyage_type",
    )


@query
def voyage_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voyage_rows(spark, sf_dir).select("id", moment("date_time_utc"), "sail_id", "municipality_voyage_route")


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = positions(spark, sf_dir)
    facts = jobs.calculated_voyages(points, points, lookups(spark, sf_dir), stamp=F.lit(STAMP).cast("timestamp"))
    rows = report.pre_aggregate(report.join_vessel_periods(facts, vessels(spark, sf_dir)))
    return report.star_join(rows, *report_inputs(spark, sf_dir))


STAR_COLUMNS = (
    "mmsi", "vessel_id", "year_month", "sail_id", "phase", "voyage_type", "municipality_id", "ship_is_stopped",
    "imo", "statcode5", "gt_group", "main_engine_fueltype", "vessel_class", "shipname", "shiptypelevel5",
    "municipality_name", "county_name", "maritime_borders_norwegian_economic_zone_area_name",
    "management_plan_marine_areas_area_name_norwegian",
)


@query
def report_star_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_rows(spark, sf_dir).select(*STAR_COLUMNS, *doubles(("co2", "fuel"), 5))


@query
def area_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.svalbard_override(star_rows(spark, sf_dir))
    return rows.groupBy(
        "maritime_borders_norwegian_economic_zone_id", "county_id", "county_name", "municipality_id", "municipality_name"
    ).agg(F.count("*").alias("n_rows"))


REPORT_PLACES = {"sum_kwh": 2, "sum_aux_kwh_shore_power": 2, "sum_boiler_kwh_shore_power": 2, "distance_kilometers": 0}


def steady_sums(df: DataFrame, default: int) -> DataFrame:
    sums = [
        name for name in df.columns
        if (name.startswith("sum_") and name != "sum_seconds") or name in ("distance_kilometers", "co2e_route_total")
    ]
    return df.withColumns({name: steady(name, min(default, REPORT_PLACES.get(name, default))) for name in sums})


@query
def emission_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steady_sums(full_report(spark, sf_dir), 5)


@query
def report_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steady_sums(views.report_view(written_report(spark, sf_dir), THIS_MONTH), 3)


@query
def top_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steady_sums(views.top_routes(written_report(spark, sf_dir), THIS_MONTH), 3)


@query
def monthly_vessel_co2(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = facts(spark, sf_dir).groupBy("vessel_id", F.date_format("date_time_utc", "yyyy-MM").alias("year_month"))
    return months.agg(
        F.sum("co2_tonnes").alias("co2_tonnes"), F.sum("main_engine_kwh").alias("main_engine_kwh")
    ).select("vessel_id", "year_month", *doubles(("co2_tonnes", "main_engine_kwh"), 5))


# ---------------------------------------------------------------- incremental


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(spark, sf_dir, "stats")


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.pending_dates(stats(spark, sf_dir), "ais_voyages", "emission")


@query
def pending_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending(spark, sf_dir).select(text("date_utc"))


@query
def date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = stats(spark, sf_dir).filter("emission IS NOT NULL")
    return incremental.date_ranges(done).select(text("start_date"), text("end_date"), "n_dates")


def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of an earlier report."""
    return derive(spark, sf_dir, "ais").filter("date_utc < DATE'1997-06-15'").select(
        F.date_format("date_utc", "yyyy-MM").alias("year_month")
    )


def finished(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incremental.dates_after(stats(spark, sf_dir), "emission", reported(spark, sf_dir))


@query
def watermark_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finished(spark, sf_dir).select(text("date_utc"), "month", "year")


@query
def days_in_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = incremental.days_in_month(finished(spark, sf_dir))
    return months.select("year", "month", "days_count", text("start_date"), text("end_date"))


@query
def complete_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = incremental.days_in_month(finished(spark, sf_dir))
    return incremental.complete_months(months).select(text("date_utc"))


@query
def quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = stats(spark, sf_dir).select(F.year("date_utc").alias("year"))
    return incremental.quarters(years).select("year", text("start_date"), text("end_date"))


@query
def job_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(spark, sf_dir).withColumn("bi_processing_time", F.lit(STAMP).cast("timestamp"))
    updates = incremental.written_dates(rows)
    merged = incremental.upsert_job_stats(stats(spark, sf_dir), updates, "emission", "bi_processing_time")
    return merged.select(text("date_utc"), moment("ais_voyages"), moment("emission"))
