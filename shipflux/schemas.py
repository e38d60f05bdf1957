"""Schemas of the CSV drops and of the written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RESCUE = "_rescue"

# CSV drops, column names and types as delivered.
EMISSION_VARIABLES = "variable string, value string, start_date string, end_date string"
VESSEL_TYPE = "statcode5 string, vessel_type string"
AUX_BOILER = (
    "vessel_type string, vessel_type_id int, low_limit int, high_limit int, size_bin int, unit string, "
    "boiler_berth int, boiler_anchor int, boiler_maneuver int, boiler_cruise int, "
    "aux_berth int, aux_anchor int, aux_maneuver int, aux_cruise int"
)
BATTERY_STREAM = (
    "mmsi string, imo string, vessel_name string, route string, battery_installation_year int, "
    "degree_of_electrification string, battery_pack_kwh string"
)
BATTERY = (
    "mmsi long, imo long, vessel_name string, route string, degree_of_electrification string, "
    "battery_pack_kwh string, start_date date, end_date date"
)
VESSEL_PORT = (
    "ship_name string, imo long, mmsi long, municipality_name string, usage_percentage string, "
    "start_date date, end_date date"
)
TYPE_PORT = (
    "vessel_type string, municipality_name string, usage_percentage string, start_date date, end_date date"
)

DROPS = {
    "emission_variables": EMISSION_VARIABLES,
    "vessel_type": VESSEL_TYPE,
    "vessel_aux_boiler_kw": AUX_BOILER,
    "vessel_battery_stream": BATTERY_STREAM,
    "vessel_battery": BATTERY,
    "vessel_port_electric": VESSEL_PORT,
    "vessel_type_port_electric": TYPE_PORT,
}

FACT = (
    "id string, date_time_utc timestamp, mmsi long, vessel_id int, phase string, sail_id string, "
    "geometry_wkt string, hex_14 long, emission_control_area_id string, "
    "management_plan_marine_areas_area_id int, maritime_borders_norwegian_economic_zone_id string, "
    "maritime_borders_norwegian_continental_shelf_id string, shore_power_id string, municipality_id string, "
    "in_coast_and_sea_area boolean, electric_shore_power_at_berth_reduction_factor double, "
    "main_engine_load_factor double, main_engine_kwh double, aux_kwh double, boiler_kwh double, "
    "fuel_tonnes double, fuel_mdo_equivalent_tonnes double, bc_tonnes double, ch4_tonnes double, "
    "co_tonnes double, co2_tonnes double, n2o_tonnes double, nmvoc_tonnes double, nox_tonnes double, "
    "pm10_tonnes double, pm2_5_tonnes double, sox_tonnes double, co2e_tonnes double, "
    "delta_previous_point_seconds long, distance_previous_point_meters double, "
    "bi_processing_time timestamp, version string"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def with_rescue(ddl: str) -> T.StructType:
    """The drop's schema plus a column that keeps rows with malformed fields whole."""
    return struct(ddl).add(RESCUE, T.StringType())


def check_schema(df: DataFrame, ddl: str) -> DataFrame:
    """Fail before writing when names or types differ from the declared table."""
    wanted = {field.name: field.dataType for field in struct(ddl)}
    found = {field.name: field.dataType for field in df.schema}
    wrong = [name for name in wanted.keys() | found.keys() if wanted.get(name) != found.get(name)]
    if wrong:
        raise TypeError(f"columns differ from the declared table: {', '.join(sorted(wrong))}")
    return df.select(*wanted)
