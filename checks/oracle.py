"""DuckDB SQL for the checks, written independently of the Spark operators.

`PARTS` are named sub-queries over the derived inputs; `FINAL` has the last SELECT
per query. `oracle_sql` puts the sub-queries a query needs in front of it.
"""

from __future__ import annotations

import re

from checks import inputs
from checks.queries import FIRST, LAST, REPORT_PLACES, STAMP, THIS_MONTH, TODAY
from shipflux import config
from shipflux.operators.register import PROPULSION_CODES, VESSEL_COLUMNS
from shipflux.operators.report import GASES, REPORT_KEYS
from shipflux.operators.size_bins import POWER_COLUMNS

PARTS: dict[str, str] = {}
FINAL: dict[str, str] = {}


def steady(expr: str, name: str | None = None, places: int = 6) -> str:
    scale = f"1e{places}"
    return f"floor(({expr}) * {scale} + 0.31371828459e0) / {scale} AS {name or expr}"


def half_up(expr: str, places: int) -> str:
    """Rounding of the shortest decimal text of a double, halves away from zero."""
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {places}) AS DOUBLE)"


def moment(expr: str, name: str | None = None) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S') AS {name or expr}"


def text(expr: str, name: str | None = None) -> str:
    return f"CAST({expr} AS VARCHAR) AS {name or expr}"


def first_row(source: str, keys: str, order: str) -> str:
    ordered = ", ".join(f"{part} NULLS FIRST" if " DESC" not in part else part for part in order.split(", "))
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {ordered}) AS rn "
        f"FROM {source}) AS ranked WHERE rn = 1"
    )


HEX_14 = "hex_14"


def parent(r: int) -> str:
    keep = 3 * (15 - r)
    return (
        f"((((hex_14 & {(1 << 52) - 1}) >> {keep}) << {keep}) | {(1 << keep) - 1} | (1::BIGINT << 59) "
        f"| ({r}::BIGINT << 52))"
    )


# ---------------------------------------------------------------- scans, parameters

FINAL["ais_scan"] = f"""
SELECT id, vessel_id, mmsi, {moment('date_time_utc')}, hex_14, {parent(7)} AS hex_7, {parent(9)} AS hex_9, sail_id,
       phase, {steady('speed_over_ground')}, voyage_type, in_coast_and_sea_area, ship_is_stopped
FROM ais WHERE date_utc BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
"""
FINAL["cell_parent"] = (
    "SELECT DISTINCT hex_14, " + ", ".join(f"{parent(r)} AS parent_{r}" for r in (0, 5, 7, 9, 13)) + " FROM ais"
)
PARTS["typed"] = """
SELECT variable, TRY_CAST(replace(value, ',', '.') AS DOUBLE) AS value,
       CAST(try_strptime(start_date, '%d.%m.%Y') AS DATE) AS start_date,
       CAST(try_strptime(end_date, '%d.%m.%Y') AS DATE) AS end_date, bi_ingested_timestamp AS seq
FROM deliveries
"""
FINAL["typed_cleanup"] = f"""
SELECT variable, value, {text('start_date')}, {text('end_date')}, {moment('seq', 'bi_ingested_timestamp')} FROM typed
"""
FINAL["null_cleanup"] = f"""
SELECT mmsi, coalesce(imo, 0) AS imo, nullif(vessel_name, 'null') AS vessel_name, nullif(route, 'null') AS route,
       {text('start_date')} FROM battery_raw
"""
PARTS["steps"] = first_row("typed", "variable, start_date, seq", "value, end_date")
PARTS["changes"] = """
SELECT * FROM (
  SELECT *, row_number() OVER w AS place, lag(value) OVER w AS old_value, lag(end_date) OVER w AS old_end
  FROM steps WINDOW w AS (PARTITION BY variable, start_date ORDER BY seq)) AS s
WHERE place = 1 OR value IS DISTINCT FROM old_value OR end_date IS DISTINCT FROM old_end
"""
PARTS["versions"] = """
SELECT variable, start_date, end_date, value, seq AS start_at,
       lead(seq) OVER (PARTITION BY variable, start_date ORDER BY seq) AS end_at
FROM changes
"""
FINAL["scd2"] = f"""
SELECT variable, {text('start_date')}, {text('end_date')}, value, {moment('start_at', '"__START_AT"')},
       {moment('end_at', '"__END_AT"')} FROM versions
"""
FINAL["stream_scd2"] = FINAL["scd2"]
PARTS["latest"] = first_row("typed", "variable", "seq DESC, value, start_date, end_date")
FINAL["scd1"] = f"""
SELECT variable, {text('start_date')}, {text('end_date')}, value, {moment('seq', 'bi_ingested_timestamp')} FROM latest
"""
PARTS["valid"] = """
SELECT * FROM versions WHERE end_at IS NULL AND start_date <= DATE '1998-05-01'
  AND (end_date IS NULL OR end_date >= DATE '1998-05-01')
"""
PARTS["as_of"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY variable
  ORDER BY start_date DESC, end_date DESC NULLS FIRST, value NULLS FIRST) AS rn FROM valid) AS s WHERE rn = 1
"""
FINAL["variables_asof"] = f"SELECT variable, value, {text('start_date')}, {text('end_date')} FROM as_of"

# ---------------------------------------------------------------- battery and port usage

PARTS["battery_typed"] = """
SELECT mmsi, coalesce(imo, 0) AS imo, nullif(vessel_name, 'null') AS vessel_name, nullif(route, 'null') AS route,
       TRY_CAST(replace(degree_of_electrification, ',', '.') AS DOUBLE) AS degree_of_electrification,
       TRY_CAST(battery_pack_kwh AS INTEGER) AS battery_pack_kwh, start_date, end_date
FROM battery_raw
"""
PARTS["battery_silver"] = first_row(
    "battery_typed", "mmsi, imo, start_date",
    "end_date, degree_of_electrification, battery_pack_kwh, route, vessel_name",
)
FINAL["dedup_subset"] = f"""
SELECT mmsi, imo, vessel_name, route, degree_of_electrification, battery_pack_kwh, {text('start_date')}, {text('end_date')}
FROM battery_silver
"""
PARTS["primary_ids"] = "SELECT vessel_id, imo, mmsi FROM identities WHERE row_number_mmsi_imo = 1"
PARTS["battery_joined"] = """
SELECT i.vessel_id, b.mmsi, b.imo, degree_of_electrification, battery_pack_kwh, start_date, end_date
FROM battery_silver AS b JOIN primary_ids AS i ON i.imo = b.imo AND i.mmsi = b.mmsi
"""
PARTS["battery"] = first_row(
    "battery_joined", "vessel_id, start_date", "mmsi, imo, end_date, degree_of_electrification, battery_pack_kwh"
)
FINAL["battery_dim"] = f"""
SELECT vessel_id, mmsi, imo, degree_of_electrification, battery_pack_kwh, {text('start_date')}, {text('end_date')} FROM battery
"""
FINAL["identity_join"] = f"""
SELECT i.vessel_id, i.imo, i.mmsi, municipality_name, {text('start_date')}
FROM primary_ids AS i JOIN vessel_port_raw AS v ON v.imo = i.imo AND v.mmsi = i.mmsi
"""
PARTS["towns"] = f"SELECT * FROM municipalities WHERE year = {config.MUNICIPALITY_YEAR}"
PARTS["vessel_port_typed"] = """
SELECT nullif(ship_name, 'null') AS ship_name, coalesce(imo, 0) AS imo, coalesce(mmsi, 0) AS mmsi,
       nullif(municipality_name, 'null') AS municipality_name,
       TRY_CAST(replace(usage_percentage, ',', '.') AS DOUBLE) AS usage_percentage, start_date, end_date
FROM vessel_port_raw
"""
PARTS["vessel_port_silver"] = first_row(
    "vessel_port_typed", "mmsi, imo, start_date", "end_date, municipality_name, usage_percentage, ship_name"
)
PARTS["vessel_port_joined"] = """
SELECT i.vessel_id, v.mmsi, v.imo, t.municipality_no, v.municipality_name, usage_percentage, start_date, end_date
FROM vessel_port_silver AS v JOIN primary_ids AS i ON i.imo = v.imo AND i.mmsi = v.mmsi
JOIN towns AS t ON t.municipality_name = v.municipality_name
"""
PARTS["vessel_port"] = first_row(
    "vessel_port_joined", "vessel_id, municipality_no, start_date", "mmsi, imo, end_date, usage_percentage, municipality_name"
)
FINAL["vessel_port_electric"] = f"""
SELECT vessel_id, mmsi, imo, municipality_no, municipality_name, usage_percentage, {text('start_date')}, {text('end_date')}
FROM vessel_port
"""
PARTS["type_port_typed"] = """
SELECT vessel_type, nullif(municipality_name, 'null') AS municipality_name,
       TRY_CAST(replace(usage_percentage, ',', '.') AS DOUBLE) AS usage_percentage, start_date, end_date
FROM type_port_raw
"""
PARTS["type_port_silver"] = first_row(
    "type_port_typed", "vessel_type, municipality_name, start_date", "end_date, usage_percentage"
)
PARTS["known_types"] = "SELECT DISTINCT vessel_type FROM vessel_types"
PARTS["type_port_joined"] = """
SELECT p.vessel_type, t.municipality_no, p.municipality_name, usage_percentage, start_date, end_date
FROM type_port_silver AS p JOIN towns AS t ON t.municipality_name = p.municipality_name
JOIN known_types AS k ON k.vessel_type = p.vessel_type
WHERE start_date IS NOT NULL
"""
PARTS["type_port"] = first_row(
    "type_port_joined", "vessel_type, municipality_no, start_date", "end_date, usage_percentage, municipality_name"
)
FINAL["type_port_electric"] = f"""
SELECT vessel_type, municipality_no, municipality_name, usage_percentage, {text('start_date')}, {text('end_date')} FROM type_port
"""
FINAL["name_lookup"] = f"""
SELECT r.vessel_type, r.municipality_name, t.municipality_no, {text('start_date')}
FROM type_port_raw AS r JOIN towns AS t ON t.municipality_name = r.municipality_name
WHERE r.vessel_type IN (SELECT vessel_type FROM known_types WHERE vessel_type IS NOT NULL)
"""
FINAL["unmatched_anti"] = """
SELECT DISTINCT 'vessel_type' AS kind, vessel_type AS name FROM type_port_silver AS s
WHERE NOT EXISTS (SELECT 1 FROM known_types AS k WHERE k.vessel_type = s.vessel_type)
UNION ALL
SELECT DISTINCT 'municipality_name', municipality_name FROM type_port_silver AS s
WHERE NOT EXISTS (SELECT 1 FROM towns AS t WHERE t.municipality_name = s.municipality_name)
"""

# ---------------------------------------------------------------- register

PARTS["engines"] = """
SELECT d.lrimoshipno AS fp_imo, d.fueltype1code AS fp_fueltype1code, d.fueltype2code AS fp_fueltype2code,
       d.MainEngineType AS fp_me_enginetype, d.propulsiontype AS fp_propulsiontype,
       m.enginebuilder AS fp_enginebuilder, m.enginemodel AS fp_enginemodel
FROM ship_data AS d LEFT JOIN (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lrno ORDER BY Position) AS rn FROM main_engines) AS e
  WHERE rn = 1) AS m ON m.lrno = d.lrimoshipno
WHERE d."__END_AT" IS NULL
"""
FINAL["engine_first_by_position"] = "SELECT * FROM engines"
PARTS["batch"] = """
SELECT * FROM (SELECT *, dense_rank() OVER (ORDER BY bi_ingested_timestamp DESC) AS dr FROM bins_raw) AS b
WHERE dr = 1 AND vessel_type IS NOT NULL
"""
FINAL["latest_batch"] = f"""
SELECT vessel_type, size_bin, unit, low_limit, aux_berth, {moment('bi_ingested_timestamp')} FROM batch
"""
PARTS["opened"] = f"""
SELECT * REPLACE (CASE WHEN low_limit = max(low_limit) OVER (PARTITION BY vessel_type)
  THEN {config.OPEN_HIGH_LIMIT} ELSE high_limit END AS high_limit) FROM batch
"""
FINAL["open_top_bin"] = "SELECT vessel_type, size_bin, low_limit, high_limit FROM opened"
PARTS["unknowns"] = """
SELECT DISTINCT vessel_type, vessel_type_id, unit, -99 AS low_limit, 0 AS high_limit, 0 AS size_bin FROM batch
"""
FINAL["unknown_bin"] = "SELECT * FROM unknowns"
_raw_powers = ", ".join(f"{name.removesuffix('_kw')} AS {name}" for name in POWER_COLUMNS)
_null_powers = ", ".join(f"CAST(NULL AS INTEGER) AS {name}" for name in POWER_COLUMNS)
_double_powers = ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in POWER_COLUMNS)
PARTS["bins"] = f"""
SELECT vessel_type, vessel_type_id, unit, low_limit, high_limit, size_bin, {_raw_powers} FROM opened
UNION ALL SELECT *, {_null_powers} FROM unknowns
"""
FINAL["size_bins"] = f"""
SELECT vessel_type, vessel_type_id, unit, low_limit, high_limit, size_bin, {_double_powers} FROM bins
"""
FINAL["keep_first"] = """
SELECT vessel_type, size_bin, min(low_limit) AS low_limit,
       arg_min(high_limit, low_limit) AS high_limit, arg_min(unit, low_limit) AS unit
FROM (SELECT * FROM bins UNION ALL SELECT * REPLACE (low_limit + 5 AS low_limit) FROM bins) AS doubled
GROUP BY vessel_type, size_bin
"""


def _or(expr: str, default: str, name: str | None = None) -> str:
    return f"coalesce({expr}, {default}) AS {name or expr.split('.')[-1]}"


PARTS["merged"] = f"""
SELECT s.vessel_id, s.mmsi_text AS mmsi, s.imo, {', '.join(_or('s.' + n, "'Unknown'") for n in ('call_sign', 'ship_name', 'flag_code', 'vessel_type_imo_ghg'))},
       {_or('t.vessel_type', "'Unknown'", 'vessel_class')}, {_or('s.statcode5', "'Unknown'")},
       {', '.join(_or('s.' + n, '-99e0') for n in ('year_of_build', 'gt', 'dwt', 'teu'))},
       coalesce(s.liquid_capacity, s.gas_capacity, -99e0) AS cbm,
       {', '.join(_or('s.' + n, '-99e0') for n in ('length_overall', 'breadth_moulded', 'draught'))},
       {_or('s.ship_type', "'Unknown'")}, {_or('s.main_engine_rpm', '-99e0')},
       {_or('s.power_kw_max', '-99e0', 'main_engine_kw')}, {_or('s.main_engine_stroke_type', '-99e0', 'stroketype')},
       {', '.join(_or('s.' + n, '-99e0') for n in ('speed_service', 'speed_max', 'power_kw_max'))},
       {_or('e.fp_fueltype1code', "'UU'")}, {_or('e.fp_fueltype2code', "'UU'")},
       {_or('e.fp_me_enginetype', "'Unknown'")}, {_or('e.fp_propulsiontype', "'Unknown'")},
       {_or('e.fp_enginebuilder', "'Unknown'", 'engine_builder')}, {_or('e.fp_enginemodel', "'Unknown'", 'engine_model')},
       {_or('b.degree_of_electrification', '0e0')},
       coalesce(b.start_date, DATE '1900-01-01') AS start_date, coalesce(b.end_date, DATE '2999-12-31') AS end_date
FROM ships AS s
LEFT JOIN engines AS e ON e.fp_imo = s.fairplay_id
LEFT JOIN battery AS b ON b.vessel_id = s.vessel_id
LEFT JOIN vessel_types AS t ON t.statcode5 = s.statcode5
WHERE s.vessel_id IN (SELECT vessel_id FROM primary_ids WHERE mmsi < 776000000)
"""
FINAL["register_merge"] = f"SELECT * REPLACE ({text('start_date')}, {text('end_date')}) FROM merged"
PARTS["sizes"] = "\nUNION ALL\n".join(
    f"SELECT vessel_id, vessel_type_imo_ghg, start_date, '{unit}' AS unit, {unit} AS unit_value FROM merged"
    for unit in config.SIZE_UNITS
)
FINAL["unpivot_units"] = f"SELECT vessel_id, vessel_type_imo_ghg, {text('start_date')}, unit, unit_value FROM sizes"
PARTS["sized"] = f"""
SELECT s.vessel_id, s.start_date, {', '.join(POWER_COLUMNS)}
FROM sizes AS s JOIN bins AS b ON b.vessel_type = s.vessel_type_imo_ghg AND b.unit = s.unit
  AND s.unit_value >= b.low_limit AND s.unit_value < b.high_limit
"""
FINAL["size_bin_join"] = f"SELECT vessel_id, {text('start_date')}, {_double_powers} FROM sized"


def ladder(column: str, edges, labels, otherwise: str, first: str) -> str:
    arms = [f"WHEN NOT ({column} {first}) OR {column} IS NULL THEN {otherwise}"]
    for upper, label in zip(edges, labels):
        arms.append(f"WHEN {column} < {upper} THEN {label}")
    return f"CASE {' '.join(arms)} ELSE {labels[-1]} END"


def quoted(*labels: str) -> list[str]:
    return [f"'{label}'" for label in labels]


_banding = {
    "length_group": ladder(
        "length_overall", (24, 50, 70, 100, 150, 225),
        quoted("l1, <24 m", "l2, 24-50 m", "l3, 50-70 m", "l4, 70-100 m", "l5, 100-150 m", "l6, 150-225 m", "l7, >=225 m"),
        "'Unknown'", "> 0"),
    "tier_group": ladder("year_of_build", (2000, 2010, 2020), (0, 1, 2, 3), "0", ">= 1900"),
    "tier_group_nox": ladder("year_of_build", (2000, 2011, 2021), (0, 1, 2, 3), "-99", ">= 1900"),
    "year_group": ladder(
        "year_of_build", (1960, 1980, 1990, 2000, 2005, 2010, 2015, 2020),
        quoted("y1, <1959", "y2, 1960-1979", "y3, 1980-1989", "y4, 1990-1999", "y5, 2000-2004", "y6, 2005-2009",
               "y7, 2010-2014", "y8, 2015-2019", "y9, >=2020"), "'Unknown'", "> 0"),
    "gt_group": ladder(
        "gt", (400, 1000, 3000, 5000, 10000, 25000, 50000, 100000),
        quoted("gt1, 0-399", "gt2, 400-999", "gt3, 1000-2999", "gt4, 3000-4999", "gt5, 5000-9999",
               "gt6, 10000-24999", "gt7, 25000-49999", "gt8, 50000-99999", "gt9, >=100 000"), "'Unknown'", "> 0"),
    "dwt_group": ladder(
        "dwt", (5000, 10000, 25000, 50000, 75000, 100000, 150000, 200000),
        quoted("dwt1, <5000", "dwt2, 5 000-10 000", "dwt3, 10 000-25 000", "dwt4, 25 000-50 000", "dwt5, 50 000-75 000",
               "dwt6, 75 000-100 000", "dwt7, 100 000-150 000", "dwt8, 150 000-200 000", "dwt9, >=200 000"),
        "'Unknown'", "> 0"),
}
PARTS["drive_codes"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{name}', '{code}')" for name, code in PROPULSION_CODES.items()
) + ") AS c(propulsion, code)"
PARTS["coded"] = f"""
SELECT m.*, s.* EXCLUDE (vessel_id, start_date), {', '.join(f'{sql} AS {name}' for name, sql in _banding.items())},
       coalesce(c.code, 'UU') AS fp_propulsiontypecode
FROM merged AS m JOIN sized AS s ON s.vessel_id = m.vessel_id AND s.start_date = m.start_date
LEFT JOIN drive_codes AS c ON c.propulsion = m.fp_propulsiontype
"""
PARTS["fuelled"] = """
SELECT *, CASE
  WHEN fp_fueltype1code IN ('LG', 'GB', 'LP') OR fp_fueltype2code IN ('LG', 'GB', 'LP') THEN 'LNG'
  WHEN 'RF' IN (fp_fueltype1code, fp_fueltype2code) AND fp_propulsiontypecode IN ('SGDE', 'SEDX', 'SE', 'SG')
    AND vessel_type_imo_ghg = 'Liquefied gas tanker' THEN 'LNG'
  WHEN fp_fueltype1code = 'CU' AND fp_fueltype2code IN ('NN', 'UU', 'YY') THEN 'Coal'
  WHEN 'NU' IN (fp_fueltype1code, fp_fueltype2code) THEN 'Nuclear'
  WHEN fp_fueltype1code = 'HY' THEN 'Hydrogen'
  WHEN fp_fueltype1code = 'ME' THEN 'Methanol'
  WHEN fp_propulsiontypecode = 'BE' THEN 'Electric'
  WHEN 'RF' IN (fp_fueltype1code, fp_fueltype2code) THEN 'Residual Fuel'
  WHEN fp_fueltype1code = 'DF' AND fp_fueltype2code IN ('DF', 'NN', 'UU', 'YY') THEN 'Distillate Fuel'
  WHEN fp_fueltype2code = 'DF' AND fp_fueltype1code IN ('NN', 'UU', 'YY', 'CU') THEN 'Distillate Fuel'
  WHEN vessel_type_imo_ghg = 'Miscellaneous - fishing' THEN 'Distillate Fuel' END AS main_engine_fueltype_original
FROM coded
"""


def _mode(keys: str) -> str:
    return (
        f"SELECT {keys}, fuel FROM (SELECT {keys}, main_engine_fueltype_original AS fuel, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY count(*) DESC, main_engine_fueltype_original) AS rn FROM fuelled "
        f"WHERE main_engine_fueltype_original IS NOT NULL GROUP BY {keys}, main_engine_fueltype_original) AS c WHERE rn = 1"
    )


PARTS["imputed"] = f"""
SELECT f.*, coalesce(main_engine_fueltype_original, a.fuel, b.fuel, c.fuel) AS main_engine_fueltype
FROM fuelled AS f
LEFT JOIN ({_mode('vessel_class, gt_group')}) AS a ON a.vessel_class = f.vessel_class AND a.gt_group = f.gt_group
LEFT JOIN ({_mode('gt_group')}) AS b ON b.gt_group = f.gt_group
LEFT JOIN ({_mode('vessel_class')}) AS c ON c.vessel_class = f.vessel_class
"""
PARTS["vessel"] = """
SELECT * REPLACE (CASE WHEN vessel_class = 'Cruise' THEN main_engine_kw * 0.7e0 ELSE main_engine_kw END AS main_engine_kw),
CASE
  WHEN 'NU' IN (fp_fueltype1code, fp_fueltype2code) THEN 'Nuclear'
  WHEN fp_fueltype1code = 'ME' THEN 'Methanol'
  WHEN fp_propulsiontypecode IN ('SG', 'SGDE', 'SE', 'SEDX') THEN 'ST'
  WHEN fp_propulsiontypecode IN ('GG', 'DEGE', 'GE', 'GGDE', 'DGGG') THEN 'GT'
  WHEN fp_propulsiontypecode = 'AE' THEN 'Hydrogen'
  WHEN fp_propulsiontypecode = 'BE' THEN 'Electric'
  WHEN starts_with(fp_propulsiontypecode, 'WS') THEN 'Sail'
  WHEN fp_me_enginetype = 'Gas' THEN 'GT'
  WHEN fp_me_enginetype = 'Turbine' THEN 'ST'
  WHEN fp_me_enginetype = 'Reciprocatng' OR fp_fueltype1code = 'CU' THEN 'Reciprocating'
  WHEN fp_fueltype1code IN ('LG', 'GB', 'LP') OR fp_fueltype2code IN ('LG', 'GB', 'LP')
    OR main_engine_fueltype = 'LNG' THEN
    CASE WHEN regexp_matches(lower(engine_model), 'df|x|me-ga') THEN 'LNG-Otto SS'
         WHEN stroketype = 4 AND main_engine_rpm > 300 THEN 'LNG-Otto MS'
         WHEN contains(lower(engine_model), 'me') THEN 'LNG-Diesel'
         WHEN fp_fueltype1code IN ('LG', 'LP', 'GB') AND fp_fueltype2code <> 'DF' AND fp_fueltype2code <> 'RF' THEN 'LBSI'
         WHEN engine_builder IN ('Rolls-Royce Marine AS - Norway', 'Bergen Engines AS - Norway') THEN 'LBSI'
         ELSE 'LNG-Otto MS' END
  WHEN fp_propulsiontypecode IN ('DEGE', 'DDWS', 'DEWS', 'DGWS', 'DD', 'DU', 'DE', 'DG', 'DDDE', 'DEDD', 'DEDG', 'DGDG',
    'DGDE', 'DGGG') THEN
    CASE WHEN main_engine_rpm > 900 THEN 'HSD' WHEN main_engine_rpm > 300 THEN 'MSD' ELSE 'SSD' END
  WHEN main_engine_fueltype IN ('Distillate Fuel', 'Residual Fuel') THEN 'SSD' END AS main_engine_enginetype
FROM imputed
"""
_vessel_list = [
    name if name not in ("start_date", "end_date", "main_engine_kw", *POWER_COLUMNS)
    else steady(name) if name == "main_engine_kw"
    else f"CAST({name} AS DOUBLE) AS {name}" if name in POWER_COLUMNS
    else text(name)
    for name in VESSEL_COLUMNS
]
FINAL["vessel_dim"] = f"SELECT {', '.join(_vessel_list)} FROM vessel"


def _vessel_part(*names: str) -> str:
    return f"SELECT vessel_id, {text('start_date')}, {', '.join(names)} FROM vessel"


FINAL["propulsion_code"] = _vessel_part("fp_propulsiontype", "fp_propulsiontypecode")
FINAL["fuel_type"] = _vessel_part(
    "fp_fueltype1code", "fp_fueltype2code", "fp_propulsiontypecode", "main_engine_fueltype_original"
)
FINAL["mode_impute"] = _vessel_part("vessel_class", "gt_group", "main_engine_fueltype_original", "main_engine_fueltype")
FINAL["engine_type"] = _vessel_part("main_engine_rpm", "stroketype", "engine_model", "main_engine_enginetype")
FINAL["banding"] = _vessel_part("year_of_build", *_banding)
FINAL["speed_correction"] = _vessel_part("vessel_class", steady("main_engine_kw"))
FINAL["vessel_current"] = """
SELECT vessel_id, ship_name, vessel_class, degree_of_electrification, gt_group FROM vessel WHERE end_date > DATE '1999-06-01'
"""
PARTS["eligible"] = "SELECT * FROM vessel WHERE vessel_class IS NOT NULL AND vessel_class NOT IN ('', 'Unknown')"
FINAL["vessel_eligible"] = _vessel_part("vessel_class").replace("FROM vessel", "FROM eligible")
FINAL["qc_counts"] = """
SELECT (SELECT count(*) FROM ships AS s LEFT JOIN battery AS b ON b.vessel_id = s.vessel_id
        WHERE s.vessel_type_imo_ghg IS NOT NULL
          AND s.vessel_id IN (SELECT vessel_id FROM primary_ids WHERE mmsi < 776000000)) AS expected_rows,
       (SELECT count(*) FROM vessel) AS actual_rows
"""

# ---------------------------------------------------------------- factors: names are spelled, then looked up

PARTS["pm"] = "SELECT map(list(variable), list(value)) AS m FROM parameter_values"
PARTS["slugged"] = """
SELECT v.*, main_engine_fueltype AS fuel, main_engine_enginetype AS eng, lower(main_engine_enginetype) AS kind,
  CASE main_engine_fueltype WHEN 'Residual Fuel' THEN 'residual_fuel' WHEN 'Distillate Fuel' THEN 'distillate_fuel'
    WHEN 'LNG' THEN 'lng' END AS fs,
  CASE main_engine_fueltype WHEN 'Residual Fuel' THEN 'distillate_fuel' WHEN 'Distillate Fuel' THEN 'distillate_fuel'
    WHEN 'LNG' THEN 'lng' END AS fs_eca,
  coalesce(main_engine_enginetype IN ('SSD', 'MSD', 'HSD'), false) AS is_diesel,
  coalesce(main_engine_enginetype IN ('GT', 'ST'), false) AS is_turbine,
  CASE main_engine_enginetype WHEN 'LNG-Otto SS' THEN 'lng_otto_ss' WHEN 'LNG-Otto MS' THEN 'lng_otto_ms'
    WHEN 'LBSI' THEN 'lng_lbsi' WHEN 'LNG-Diesel' THEN 'lng_diesel' END AS gas,
  CASE WHEN year_of_build <= 1983 THEN 'year_0_1983' WHEN year_of_build <= 2000 THEN 'year_1984_2000'
    ELSE 'year_2001_2999' END AS age,
  CASE WHEN year_of_build <= 2000 THEN 'year_0_2000' WHEN year_of_build >= 2001 THEN 'year_2001_2999' END AS era, p.m
FROM eligible AS v CROSS JOIN pm AS p
"""


def _combustion(pollutant: str, area: str) -> str:
    fs = "fs_eca" if area == "eca" else "fs"
    return f"""m['{pollutant}_main_engine_' || CASE WHEN fuel = 'Methanol' THEN 'methanol'
      WHEN is_diesel AND fuel IN ('Residual Fuel', 'Distillate Fuel') THEN kind || '_' || {fs}
      WHEN is_turbine THEN kind || CASE WHEN fuel IN ('LNG', 'Distillate Fuel') THEN '_' || fs ELSE '' END
      WHEN gas IS NOT NULL THEN gas END]"""


def _nox(area: str) -> str:
    def tier(level: str, curve: str) -> str:
        speed = f"""WHEN main_engine_rpm > 0 AND main_engine_rpm < 130 THEN m['nox_main_engine_tier_{level}_rpm_1_129']
          WHEN main_engine_rpm >= 130 AND main_engine_rpm < 2000 THEN {curve}
          WHEN main_engine_rpm >= 2000 THEN m['nox_main_engine_tier_{level}_rpm_2000_']""" if curve else ""
        electric = "WHEN fuel = 'Electric' THEN 0e0" if level == "3" else ""
        return f"""CASE WHEN eng = 'LNG-Diesel' THEN m['nox_main_engine_tier_{level}_lng_diesel'] {electric} {speed}
          WHEN is_diesel THEN m['nox_main_engine_tier_{level}_' || kind] END"""

    everywhere = f"""CASE WHEN is_turbine THEN m['nox_main_engine_' || kind || CASE WHEN fuel = 'LNG' THEN '_lng' ELSE '' END]
      WHEN gas IN ('lng_otto_ss', 'lng_otto_ms', 'lng_lbsi') THEN m['nox_main_engine_' || gas]
      WHEN fuel = 'Electric' THEN 0e0
      WHEN tier_group_nox = 0 THEN {tier('0', '')}
      WHEN tier_group_nox = 1 THEN {tier('1', '45e0 * pow(main_engine_rpm, -0.2e0)')}
      WHEN tier_group_nox IN (2, 3) THEN {tier('2', '44e0 * pow(main_engine_rpm, -0.23e0)')} END"""
    if area == "global":
        return everywhere
    covered = "(eng = 'LNG-Diesel' OR fuel = 'Electric' OR main_engine_rpm > 0 OR is_diesel)"
    third = tier("3", "9e0 * pow(main_engine_rpm, -0.2e0)")
    return f"CASE WHEN tier_group_nox = 3 AND coalesce({covered}, false) THEN {third} ELSE {everywhere} END"


def _sulphur(area: str) -> str:
    if area == "eca":
        return "m['fuel_sulfur_fraction_eca']"
    return """CASE WHEN fuel IN ('Distillate Fuel', 'Residual Fuel') THEN m['fuel_sulfur_fraction_global_' || fs]
      ELSE m['fuel_sulfur_fraction_global'] END"""


def _pm_gas(engine: str) -> str:
    return f"""m['pm_{engine}_lng_' || CASE eng WHEN 'LNG-Otto SS' THEN 'otto_ss' WHEN 'LBSI' THEN 'lbsi' WHEN 'GT' THEN 'gt'
      WHEN 'ST' THEN 'st' ELSE 'otto_ms' END]"""


def _pm(engine: str, area: str, sfc: str, sulphur: str) -> str:
    return f"""CASE fuel WHEN 'Residual Fuel' THEN 1.35e0 + {sfc} * 7 * 0.02247e0 * ({sulphur} - 0.0246e0)
      WHEN 'Distillate Fuel' THEN 0.23e0 + {sfc} * 7 * 0.02247e0 * ({sulphur} - 0.0024e0)
      WHEN 'Methanol' THEN (1.35e0 + {sfc} * 7 * 0.02247e0 * ({sulphur} - 0.0246e0)) * 0.1e0
      WHEN 'LNG' THEN {_pm_gas(engine)} END"""


def _area_columns(area: str) -> dict[str, str]:
    fs = "fs_eca" if area == "eca" else "fs"
    columns = {
        "cf": f"m['cf_' || CASE WHEN fs IS NOT NULL THEN {fs} WHEN fuel = 'Methanol' THEN 'methanol' ELSE 'other' END]",
        "fuel_sulfur_fraction": _sulphur(area),
        "ch4_main_engine": """m['ch4_main_engine_' || CASE WHEN fuel = 'Methanol' THEN 'methanol' WHEN is_diesel THEN kind
          WHEN gas IS NOT NULL THEN gas WHEN is_turbine THEN kind || CASE WHEN fuel = 'LNG' THEN '_lng' ELSE '' END END]""",
        "co_main_engine": _combustion("co", area),
        "n2o_main_engine": _combustion("n2o", area),
        "nmvoc_main_engine": """m['nmvoc_main_engine_' || CASE WHEN eng IN ('SSD', 'MSD') AND fuel = 'Methanol'
          THEN kind || '_methanol' WHEN is_diesel THEN kind
          WHEN is_turbine THEN kind || CASE WHEN fuel = 'LNG' THEN '_lng' ELSE '' END WHEN gas IS NOT NULL THEN gas END]""",
        "nox_main_engine": _nox(area),
    }
    for engine in ("aux", "boiler"):
        for pollutant in ("bc", "co", "n2o", "nox"):
            columns[f"{pollutant}_{engine}"] = f"m['{pollutant}_{engine}_' || {fs}]"
        for pollutant in ("ch4", "nmvoc"):
            columns[f"{pollutant}_{engine}"] = f"m['{pollutant}_{engine}_' || fs]"
        columns[f"pm_{engine}"] = _pm(engine, area, f"sfc_{engine}", f"({_sulphur(area)})")
    for engine in config.ENGINES:
        columns[f"sox_{engine}"] = f"""CASE WHEN fuel IN ('Residual Fuel', 'Distillate Fuel')
          THEN 2 * 0.97753e0 * ({_sulphur(area)}) WHEN fuel = 'LNG' THEN m['sox_{engine}_lng']
          WHEN fuel = 'Methanol' THEN m['sox_{engine}_methanol'] END"""
    eca_switch = "fuel = 'Residual Fuel' AND stroketype IN (2, 4)" if area == "eca" else "false"
    for name, values in (
        ("coefficient", ("3.11e-5", "1.201e-4", "1.5e-4", "2.5e-4", "1.5e-5", "2.5e-5")),
        ("exponent", ("-0.397e0", "-1.124e0", "-0.359e0", "-0.968e0", "-0.359e0", "-0.968e0")),
    ):
        d2, d4, r2, r4, m2, m4 = values
        columns[f"bc_main_engine_{name}"] = f"""CASE WHEN {eca_switch} THEN CASE stroketype WHEN 2 THEN {d2} ELSE {d4} END
          WHEN is_diesel THEN CASE WHEN fuel = 'Residual Fuel' THEN CASE stroketype WHEN 2 THEN {r2} WHEN 4 THEN {r4} END
            WHEN fuel = 'Distillate Fuel' THEN CASE stroketype WHEN 2 THEN {d2} WHEN 4 THEN {d4} END
            WHEN fuel = 'Methanol' THEN CASE stroketype WHEN 2 THEN {m2} WHEN 4 THEN {m4} END END END"""
    columns["bc_main_engine_flat"] = """m['bc_main_engine_' || CASE WHEN is_diesel THEN NULL
      WHEN fuel = 'LNG' AND gas IS NOT NULL THEN gas WHEN fuel = 'LNG' AND is_turbine THEN 'lng_' || kind
      WHEN fuel = 'Residual Fuel' AND is_turbine THEN 'residual_fuel_' || kind
      WHEN fuel = 'Distillate Fuel' AND is_turbine THEN 'residual_fuel_st' END]"""
    line = {
        "base": "CASE fuel WHEN 'Residual Fuel' THEN 1.35e0 WHEN 'Distillate Fuel' THEN 0.23e0 WHEN 'Methanol' THEN 0.135e0 "
                f"WHEN 'LNG' THEN {_pm_gas('main_engine')} END",
        "slope": f"CASE fuel WHEN 'Residual Fuel' THEN (({_sulphur(area)}) - 0.0246e0) * 0.15729e0 "
                 f"WHEN 'Distillate Fuel' THEN (({_sulphur(area)}) - 0.0024e0) * 0.15729e0 "
                 f"WHEN 'Methanol' THEN (({_sulphur(area)}) - 0.0246e0) * 0.015729e0 END",
    }
    columns.update({f"pm_main_engine_{name}": sql for name, sql in line.items()})
    return columns


PARTS["based"] = """
SELECT *,
  m['sfc_main_engine_' || CASE
    WHEN is_diesel AND fuel IN ('Distillate Fuel', 'Residual Fuel') THEN fs || '_' || kind || '_' || age
    WHEN eng IN ('SSD', 'MSD') AND fuel = 'Methanol' THEN 'methanol_' || kind
    WHEN gas IN ('lng_diesel', 'lng_otto_ss') AND era = 'year_2001_2999' THEN gas || '_' || era
    WHEN gas IN ('lng_otto_ms', 'lng_lbsi') THEN gas || '_' || era
    WHEN is_turbine THEN fs || '_' || kind END] AS sfc_main_engine_baseline,
  CASE WHEN gas IN ('lng_diesel', 'lng_otto_ss') AND era = 'year_2001_2999'
    THEN m['sfc_main_engine_' || gas || '_year_2001_2999_pilot_fuel'] ELSE 0e0 END AS sfc_pilot_fuel,
  m['sfc_aux_' || CASE WHEN fuel IN ('Distillate Fuel', 'Residual Fuel') THEN fs || '_' || age
    WHEN fuel = 'LNG' THEN 'lng_' || coalesce(era, 'year_2001_2999') END] AS sfc_aux,
  m['sfc_boiler_' || fs] AS sfc_boiler,
  m['fuel_equivalent_' || CASE fuel WHEN 'Residual Fuel' THEN 'hfo' WHEN 'Distillate Fuel' THEN 'mdo' WHEN 'LNG' THEN 'lng'
    WHEN 'Methanol' THEN 'methanol' END] AS mdo_equivalent
FROM slugged
"""
PARTS["fac"] = "SELECT *, " + ",\n".join(
    f"{sql} AS {name}_{area}" for area in ("global", "eca") for name, sql in _area_columns(area).items()
) + " FROM based"


def _factor_final(*names: str, plain: tuple[str, ...] = ()) -> str:
    columns = [*plain, *(f"{name}_{area}" for name in names for area in ("global", "eca"))]
    return (
        f"SELECT vessel_id, {text('start_date')}, main_engine_fueltype, main_engine_enginetype, "
        + ", ".join(steady(name, places=9) for name in columns) + " FROM fac"
    )


def _engines(pollutant: str) -> list[str]:
    return [f"{pollutant}_{engine}" for engine in config.ENGINES]


FINAL["ef_co2"] = _factor_final("cf")
for _name in ("ch4", "co", "n2o", "nmvoc", "nox"):
    FINAL[f"ef_{_name}"] = _factor_final(*_engines(_name))
FINAL["ef_bc"] = _factor_final(
    "bc_main_engine_coefficient", "bc_main_engine_exponent", "bc_main_engine_flat", "bc_aux", "bc_boiler"
)
FINAL["ef_sox_pm"] = _factor_final(
    "fuel_sulfur_fraction", *_engines("sox"), "pm_main_engine_base", "pm_main_engine_slope", "pm_aux", "pm_boiler"
)
FINAL["sfc_main"] = _factor_final(plain=("sfc_main_engine_baseline", "sfc_pilot_fuel"))
FINAL["sfc_aux_boiler"] = _factor_final(plain=("sfc_aux", "sfc_boiler"))

# ---------------------------------------------------------------- positions

PARTS["in_period"] = """
SELECT a.*, v.start_date AS period_start FROM ais AS a
JOIN eligible AS v ON v.vessel_id = a.vessel_id AND a.date_utc BETWEEN v.start_date AND v.end_date
"""
FINAL["interval_join"] = f"""
SELECT id, vessel_id, mmsi, {moment('date_time_utc')}, {text('period_start')} FROM in_period
"""
PARTS["uniq"] = first_row(
    "in_period", "mmsi, date_time_utc",
    "id, vessel_id, period_start, hex_14, sail_id, phase, speed_over_ground, delta_previous_point_seconds",
)
FINAL["point_dedup"] = f"SELECT id, mmsi, {moment('date_time_utc')}, {text('period_start')} FROM uniq"

_ECO, _SHELF = "maritime_borders_norwegian_economic_zone", "maritime_borders_norwegian_continental_shelf"
PARTS["town_2024"] = "SELECT municipality_id, municipality_name_no, hex_9 FROM layer_town WHERE year = 2024"
FINAL["area_layers"] = f"""
SELECT t.hex_9, t.municipality_id, t.municipality_name_no AS municipality_name, z.id AS {_ECO}_id,
       z.area_name AS {_ECO}_area_name
FROM town_2024 AS t JOIN layer_zone AS z ON z.hex_9 = t.hex_9
"""
PARTS["one_eca"] = first_row("layer_eca", "hex_7", "id")
PARTS["one_plan"] = first_row("layer_plan", "hex_7", "area_id, area_name_norwegian")
PARTS["one_zone"] = first_row("layer_zone", "hex_9", "id, area_name")
PARTS["one_shelf"] = first_row("layer_shelf", "hex_9", "id")
PARTS["one_town"] = first_row("town_2024", "hex_9", "municipality_id, municipality_name_no")


def located(source: str) -> str:
    """Areas by one join per layer; shore power by ranking all installations of a position."""
    return f"""
SELECT a.*, e.id AS emission_control_area_id, p.area_id AS management_plan_marine_areas_area_id,
       p.area_name_norwegian AS management_plan_marine_areas_area_name_norwegian, z.id AS {_ECO}_id,
       z.area_name AS {_ECO}_area_name, s.id AS {_SHELF}_id, t.municipality_id, t.municipality_name_no AS municipality_name,
       i.bi_row_sha AS shore_power_id, i.usage_percentage AS shore_power_usage_percentage,
       i.hex_kring_distance_9_1 AS shore_power_hex_kring_distance_9_1
FROM (SELECT *, {parent(7)} AS hex_7, {parent(9)} AS hex_9 FROM {source}) AS a
LEFT JOIN one_eca AS e ON e.hex_7 = a.hex_7 LEFT JOIN one_plan AS p ON p.hex_7 = a.hex_7
LEFT JOIN one_zone AS z ON z.hex_9 = a.hex_9 LEFT JOIN one_shelf AS s ON s.hex_9 = a.hex_9
LEFT JOIN one_town AS t ON t.hex_9 = a.hex_9
LEFT JOIN (SELECT * FROM (
    SELECT c.hex_9, c.y, n.*, row_number() OVER (PARTITION BY c.hex_9, c.y
      ORDER BY n.hex_kring_distance_9_1 NULLS FIRST, n.bi_row_sha NULLS FIRST, n.usage_percentage NULLS FIRST) AS rn
    FROM (SELECT DISTINCT {parent(9)} AS hex_9, year(date_time_utc) AS y FROM {source}) AS c
    JOIN installations AS n ON n.hex_kring_9_1 = c.hex_9 AND c.y >= n.year) AS ranked WHERE rn = 1) AS i
  ON i.hex_9 = a.hex_9 AND i.y = year(a.date_time_utc)
"""


PARTS["all_loc"] = located("ais")
PARTS["loc"] = located("uniq")
FINAL["cell_join"] = f"""
SELECT id, {moment('date_time_utc')}, emission_control_area_id, management_plan_marine_areas_area_id,
       management_plan_marine_areas_area_name_norwegian, {_ECO}_id, {_ECO}_area_name, {_SHELF}_id, municipality_id,
       municipality_name
FROM all_loc
"""
FINAL["kring_nearest_join"] = f"""
SELECT id, {moment('date_time_utc')}, shore_power_id, {steady('shore_power_usage_percentage')},
       shore_power_hex_kring_distance_9_1 FROM all_loc
"""
_flags = f"""coalesce(shore_power_hex_kring_distance_9_1, 99) AS dist_to_power,
  coalesce(shore_power_hex_kring_distance_9_1, 99) <= {config.CLOSE_TO_POWER_CELLS} AS close_to_power,
  emission_control_area_id IS NOT NULL AS eca,
  management_plan_marine_areas_area_id IS NOT NULL AS in_management_planning_area,
  {_SHELF}_id IS NOT NULL AS in_norwegian_continental_shelf"""
FINAL["area_flags"] = f"SELECT id, {moment('date_time_utc')}, {_flags} FROM all_loc"
_ends = f"coalesce(u.end_date, DATE '{TODAY}')"
PARTS["port"] = f"""
SELECT l.*, {_flags}, f.* EXCLUDE (vessel_id, mmsi, imo, start_date, end_date, m),
       u.usage_percentage AS usage_percentage_vessel_port_electric,
       w.usage_percentage AS usage_percentage_vessel_type_port_electric
FROM loc AS l JOIN fac AS f ON f.vessel_id = l.vessel_id AND f.start_date = l.period_start
LEFT JOIN vessel_port AS u ON u.vessel_id = l.vessel_id AND u.municipality_no = l.municipality_id
  AND l.date_utc BETWEEN u.start_date AND {_ends}
LEFT JOIN type_port AS w ON w.vessel_type = f.vessel_class AND w.municipality_no = l.municipality_id
  AND l.date_utc BETWEEN w.start_date AND {_ends.replace('u.', 'w.')}
"""
FINAL["port_electric_join"] = f"""
SELECT mmsi, {moment('date_time_utc')}, municipality_id, vessel_class, usage_percentage_vessel_port_electric,
       usage_percentage_vessel_type_port_electric FROM port
"""


def powered(source: str) -> dict[str, str]:
    """Load and energy, one step per sub-query."""
    def phase_kw(engine: str) -> str:
        return f"""CASE WHEN phase = 'a' THEN {engine}_anchor_kw WHEN phase IN ('aq', 'dp-o', 'f', 'm') THEN {engine}_maneuver_kw
          WHEN phase = 'c' THEN {engine}_cruise_kw WHEN phase = 'n' THEN {engine}_berth_kw ELSE 0 END
          * delta_previous_point_seconds / 3600
          * CASE WHEN phase = 'n' AND vessel_class IN ('Gasstankskip', 'Oljetanker') AND sail_time_remaining_seconds >= 172800
              THEN 1e0 / 3 WHEN phase = 'n' AND vessel_class NOT IN ('Gasstankskip', 'Oljetanker')
              AND sail_time_remaining_seconds >= 86400 THEN 0.75e0 ELSE 1e0 END"""

    small = "main_engine_kw > 0 AND main_engine_kw <= 150"
    return {
        f"{source}_cube": f"""SELECT *, CASE WHEN speed_service = 0 THEN NULL
          ELSE pow(speed_over_ground / speed_service, 3e0) END AS cube FROM {source}""",
        f"{source}_load": f"""SELECT *, CASE WHEN phase IN ('n', 'a') THEN 0e0
          WHEN phase = 'dp-o' AND CASE WHEN cube < 0 THEN 0e0 WHEN cube > 0.98e0 THEN 0.98e0 ELSE cube END < 0.1e0 THEN 0.1e0
          WHEN cube < 0 THEN 0e0 WHEN cube > 0.98e0 THEN 0.98e0 ELSE cube END AS main_engine_load_factor
          FROM {source}_cube""",
        f"{source}_kwh": f"""SELECT *,
          main_engine_load_factor * main_engine_kw * 0.85e0 * delta_previous_point_seconds / 3600 AS main_engine_kwh,
          CASE WHEN {small} THEN 0e0 WHEN main_engine_kw > 150 AND main_engine_kw <= 500
            THEN main_engine_kw * 0.05e0 * delta_previous_point_seconds / 3600 ELSE {phase_kw('aux')} END AS aux_kwh,
          CASE WHEN {small} THEN 0e0 ELSE {phase_kw('boiler')} END AS boiler_kwh,
          CASE WHEN main_engine_enginetype IN ('GT', 'ST') THEN sfc_main_engine_baseline ELSE sfc_main_engine_baseline
            * (0.455e0 * main_engine_load_factor * main_engine_load_factor - 0.71e0 * main_engine_load_factor + 1.28e0)
            + sfc_pilot_fuel END AS sfc_main_engine
          FROM {source}_load""",
    }


PARTS["sea"] = """
SELECT l.*, f.* EXCLUDE (vessel_id, mmsi, imo, start_date, end_date, m)
FROM uniq AS l JOIN fac AS f ON f.vessel_id = l.vessel_id AND f.start_date = l.period_start
"""
PARTS.update(powered("sea"))
PARTS.update(powered("port"))


def _point_final(source: str, *names: str, places: int = 6, plain: tuple[str, ...] = ()) -> str:
    columns = [*plain, *(steady(name, places=places) for name in names)]
    return f"SELECT mmsi, {moment('date_time_utc')}, {', '.join(columns)} FROM {source}"


FINAL["load_factor"] = _point_final("sea_kwh", "main_engine_load_factor")
FINAL["main_kwh"] = _point_final("sea_kwh", "main_engine_kwh")
FINAL["aux_boiler_kwh"] = _point_final("sea_kwh", "aux_kwh", "boiler_kwh")
FINAL["sfc_load"] = _point_final("sea_kwh", "sfc_main_engine", "sfc_aux", "sfc_boiler")


def _low_load(pollutant: str, m: str) -> str:
    edges = ["0.0001e0", *(f"{step / 100}e0" for step in range(2, 20))]
    names = ["00001", *(f"{step / 100}".replace(".", "") for step in range(2, 20))]
    arms = " ".join(
        f"WHEN main_engine_load_factor > {low} AND main_engine_load_factor <= {high} THEN "
        f"{m}['low_load_{pollutant}_main_engine_{a}_{b}']"
        for low, high, a, b in zip(edges, edges[1:], names, names[1:])
    )
    return f"CASE {arms} ELSE 1e0 END"


_low_names = ("pm10", "nox", "co", "ch4", "nmvoc", "n2o")
PARTS["low"] = "SELECT s.*, " + ", ".join(
    f"{_low_load(name, 'p.m')} AS {name}_main_engine_low_load_factor" for name in _low_names
) + " FROM sea_kwh AS s CROSS JOIN pm AS p"
FINAL["low_load"] = (
    f"SELECT mmsi, {moment('date_time_utc')}, "
    + ", ".join(steady(f"{n}_main_engine_low_load_factor", f"{n}_low_load_factor") for n in _low_names)
    + " FROM low"
)
PARTS["berth"] = """
SELECT *, coalesce(close_to_power AND phase = 'n' AND sail_time_remaining_seconds > 7200, false)
  AS electric_shore_power_at_berth FROM port_kwh
"""
PARTS["shore"] = """
SELECT * REPLACE (CASE WHEN electric_shore_power_at_berth THEN 'p' ELSE phase END AS phase),
  round(1 - CASE WHEN electric_shore_power_at_berth THEN coalesce(usage_percentage_vessel_port_electric,
    usage_percentage_vessel_type_port_electric, shore_power_usage_percentage) ELSE 0e0 END, 2)
  AS electric_shore_power_at_berth_reduction_factor
FROM berth
"""
FINAL["shore_power"] = _point_final(
    "shore",
    plain=("electric_shore_power_at_berth", "electric_shore_power_at_berth_reduction_factor", "phase"),
)
PARTS["burnt"] = "SELECT *, " + ", ".join(
    f"sfc_{e} * {e}_kwh * (1 - degree_of_electrification) * electric_shore_power_at_berth_reduction_factor / 1000000 "
    f"AS {e}_fuel_tonnes" for e in config.ENGINES
) + " FROM shore"


def _known_sum(names) -> str:
    return " + ".join(f"coalesce({name}, 0e0)" for name in names)


PARTS["fuel_totals"] = f"""
SELECT *, {_known_sum(f'{e}_fuel_tonnes' for e in config.ENGINES)} AS fuel_tonnes,
       {_known_sum(f'mdo_equivalent * {e}_fuel_tonnes' for e in config.ENGINES)} AS fuel_mdo_equivalent_tonnes
FROM burnt
"""
FINAL["fuel_tonnes"] = _point_final(
    "fuel_totals", *(f"{e}_fuel_tonnes" for e in config.ENGINES), "fuel_tonnes", places=9
)
FINAL["fuel_equivalent"] = _point_final("fuel_totals", "fuel_mdo_equivalent_tonnes", places=9)

_net = "(1 - degree_of_electrification) * electric_shore_power_at_berth_reduction_factor / 1000000"


def _switch(name: str) -> str:
    return f"CASE WHEN eca THEN {name}_eca ELSE {name}_global END"


def _bc_main() -> str:
    def curve(area: str) -> str:
        return f"bc_main_engine_coefficient_{area} * pow(main_engine_load_factor, bc_main_engine_exponent_{area})"

    factor = f"""CASE WHEN eca THEN CASE WHEN main_engine_load_factor > 0 THEN
        coalesce({curve('eca')}, bc_main_engine_flat_eca) ELSE 0e0 END
      WHEN is_diesel THEN CASE WHEN main_engine_load_factor > 0 THEN {curve('global')} ELSE 0e0 END
      ELSE bc_main_engine_flat_global END"""
    return f"""{factor} * CASE WHEN fuel = 'LNG' OR eng IN ('ST', 'GT')
      THEN main_engine_kwh * (1 - degree_of_electrification) / 1000000 ELSE main_engine_fuel_tonnes END"""


_per_engine: dict[str, str] = {}
for _engine in config.ENGINES:
    for _name in ("ch4", "co", "n2o", "nmvoc", "nox"):
        _per_engine[f"{_name}_{_engine}_tonnes"] = f"{_switch(f'{_name}_{_engine}')} * {_engine}_kwh * {_net}"
    _per_engine[f"co2_{_engine}_tonnes"] = f"{_switch('cf')} * {_engine}_fuel_tonnes"
    _per_engine[f"sox_{_engine}_tonnes"] = f"{_switch(f'sox_{_engine}')} * {_engine}_fuel_tonnes"
    if _engine == "main_engine":
        _per_engine["bc_main_engine_tonnes"] = _bc_main()
        _pm_main = _pm("main_engine", "", "sfc_main_engine", f"({_switch('fuel_sulfur_fraction')})").replace("m['", "p.m['")
        _per_engine["pm10_main_engine_tonnes"] = f"({_pm_main}) * main_engine_kwh * {_net}"
    else:
        _per_engine[f"bc_{_engine}_tonnes"] = f"{_switch(f'bc_{_engine}')} * {_engine}_kwh * {_net}"
        _per_engine[f"pm10_{_engine}_tonnes"] = f"{_switch(f'pm_{_engine}')} * {_engine}_kwh * {_net}"
PARTS["raw_emission"] = "SELECT t.*, p.m, " + ", ".join(
    f"{sql} AS {name}" for name, sql in _per_engine.items()
) + " FROM fuel_totals AS t CROSS JOIN pm AS p"
PARTS["em"] = (
    "SELECT * REPLACE (" + ", ".join(
        f"{_low_load(n, 'm')} * {n}_main_engine_tonnes AS {n}_main_engine_tonnes" for n in _low_names
    ) + "), pm10_main_engine_tonnes * m['pm_2_5'] AS pm2_5_tonnes FROM raw_emission"
)
PARTS["totals"] = "SELECT *, " + ", ".join(
    f"{_known_sum(f'{n}_{e}_tonnes' for e in config.ENGINES)} AS {n}_tonnes" for n in config.POLLUTANTS
) + " FROM em"
PARTS["fact"] = f"""
SELECT *, co2_tonnes * m['co2e_gwp100_co2'] + ch4_tonnes * m['co2e_gwp100_ch4'] + n2o_tonnes * m['co2e_gwp100_n2o']
  AS co2e_tonnes, TIMESTAMP '{STAMP}' AS bi_processing_time, '{config.VERSION}' AS version FROM totals
"""
for _name in ("bc", "ch4", "co", "co2", "n2o", "nmvoc", "nox", "sox"):
    FINAL[f"emission_{_name}"] = _point_final("em", *(f"{_name}_{e}_tonnes" for e in config.ENGINES), places=9)
FINAL["emission_pm"] = _point_final("em", *(f"pm10_{e}_tonnes" for e in config.ENGINES), "pm2_5_tonnes", places=9)
FINAL["emission_total"] = _point_final("fact", *(f"{n}_tonnes" for n in config.POLLUTANTS), "fuel_tonnes", places=9)
FINAL["emission_co2e"] = _point_final("fact", "co2e_tonnes", places=9)
FINAL["point_emission"] = f"""
SELECT id, {moment('date_time_utc')}, mmsi, vessel_id, phase, sail_id, geometry_wkt, hex_14, emission_control_area_id,
       management_plan_marine_areas_area_id, {_ECO}_id, {_SHELF}_id, shore_power_id, municipality_id,
       in_coast_and_sea_area, electric_shore_power_at_berth_reduction_factor,
       {', '.join(steady(n) for n in ('main_engine_load_factor', 'main_engine_kwh', 'aux_kwh', 'boiler_kwh', 'fuel_tonnes',
                                      'fuel_mdo_equivalent_tonnes', *(f'{g}_tonnes' for g in GASES)))},
       delta_previous_point_seconds, {steady('distance_previous_point_meters')}, {moment('bi_processing_time')}, version
FROM fact
"""

# ---------------------------------------------------------------- report

FINAL["fact_scan"] = f"""
SELECT mmsi, {moment('date_time_utc')}, strftime(date_time_utc, '%Y') AS year, left(municipality_id, 2) AS county_id,
       {steady('aux_kwh * (1 - electric_shore_power_at_berth_reduction_factor)', 'aux_kwh_shore_power')},
       {steady('boiler_kwh * (1 - electric_shore_power_at_berth_reduction_factor)', 'boiler_kwh_shore_power')},
       in_norwegian_continental_shelf, version
FROM fact WHERE CAST(date_time_utc AS DATE) BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
"""
PARTS["joined"] = """
SELECT f.* EXCLUDE (voyage_type, ship_is_stopped, delta_previous_point_seconds, distance_previous_point_meters,
         unlocode_country_code),
       a.voyage_type, a.ship_is_stopped, a.delta_previous_point_seconds, a.distance_previous_point_meters,
       a.unlocode_country_code
FROM fact AS f JOIN ais AS a ON a.mmsi = f.mmsi AND a.date_time_utc = f.date_time_utc
"""
FINAL["fact_voyage_join"] = f"""
SELECT mmsi, {moment('date_time_utc')}, voyage_type, ship_is_stopped, municipality_id, unlocode_country_code,
       {steady('co2_tonnes')}, {steady('distance_previous_point_meters')} FROM joined
"""
PARTS["report_towns"] = "SELECT municipality_no, municipality_name_no AS town FROM towns"


def voyage_windows(source: str) -> str:
    whole = "ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING"
    order = "date_time_utc, mmsi, municipality_id NULLS FIRST"
    return f"""
SELECT *, CASE WHEN ship_is_stopped THEN 'Berthed' WHEN n_here = n_all THEN 'Local'
    WHEN municipality_id_start = municipality_id OR municipality_id_end = municipality_id THEN 'Departure or destination'
    ELSE 'Transit' END AS municipality_voyage_type,
  CASE WHEN municipality_id_start <> municipality_id_end THEN
    array_to_string(list_sort(list_filter([start_town, end_town], lambda x: x IS NOT NULL)), ' - ') END
    AS municipality_voyage_route
FROM (SELECT w.*, s.town AS start_town, e.town AS end_town FROM (
    SELECT *, first(municipality_id) OVER (PARTITION BY sail_id ORDER BY {order} {whole}) AS municipality_id_start,
      last(municipality_id) OVER (PARTITION BY sail_id ORDER BY {order} {whole}) AS municipality_id_end,
      count(*) OVER (PARTITION BY sail_id) AS n_all,
      count(*) OVER (PARTITION BY sail_id, municipality_id) AS n_here FROM {source}) AS w
  LEFT JOIN report_towns AS s ON s.municipality_no = w.municipality_id_start
  LEFT JOIN report_towns AS e ON e.municipality_no = w.municipality_id_end) AS named
"""


PARTS["all_voyages"] = voyage_windows("all_loc")
FINAL["voyage_type"] = f"""
SELECT id, {moment('date_time_utc')}, sail_id, municipality_id, municipality_id_start, municipality_id_end,
       municipality_voyage_type FROM all_voyages
"""
FINAL["voyage_route"] = f"SELECT id, {moment('date_time_utc')}, sail_id, municipality_voyage_route FROM all_voyages"
PARTS["voyaged"] = voyage_windows("joined")
PARTS["zone_names"] = "SELECT DISTINCT id, area_name FROM layer_zone"
PARTS["plan_names"] = "SELECT DISTINCT area_id, area_name_norwegian FROM layer_plan"
PARTS["starred"] = f"""
SELECT j.* EXCLUDE (gt_group, gt, main_engine_fueltype, degree_of_electrification, vessel_class, statcode5,
         {_ECO}_area_name, management_plan_marine_areas_area_name_norwegian, municipality_name),
       left(j.municipality_id, 2) AS county_id, strftime(j.date_time_utc, '%Y') AS year,
       strftime(j.date_time_utc, '%m') AS month, strftime(j.date_time_utc, '%Y-%m') AS year_month,
       v.imo, v.statcode5, v.gt_group, v.gt, v.main_engine_fueltype, v.degree_of_electrification, v.vessel_class,
       n.shipname, n.shiptypelevel5, t.town AS municipality_name, c.navn_norsk AS county_name,
       z.area_name AS {_ECO}_area_name, p.area_name_norwegian AS management_plan_marine_areas_area_name_norwegian
FROM voyaged AS j
LEFT JOIN vessel AS v ON v.vessel_id = j.vessel_id AND CAST(j.date_time_utc AS DATE) BETWEEN v.start_date AND v.end_date
LEFT JOIN ship_names AS n ON n.csid = j.vessel_id
LEFT JOIN report_towns AS t ON t.municipality_no = j.municipality_id
LEFT JOIN counties AS c ON c.fylkesnummer = left(j.municipality_id, 2) AND c.year = {config.MUNICIPALITY_YEAR}
LEFT JOIN zone_names AS z ON z.id = j.{_ECO}_id
LEFT JOIN plan_names AS p ON p.area_id = j.management_plan_marine_areas_area_id
"""
_star_keys = """mmsi, vessel_id, year_month, sail_id, phase, voyage_type, municipality_id, ship_is_stopped, imo, statcode5, gt_group,
  main_engine_fueltype, vessel_class, shipname, shiptypelevel5, municipality_name, county_name"""
_raw_keys = f"""period_start, {_ECO}_id, management_plan_marine_areas_area_id, in_coast_and_sea_area,
  in_norwegian_continental_shelf, version, county_id, year"""
FINAL["report_star_join"] = f"""
SELECT {_star_keys}, {_ECO}_area_name, management_plan_marine_areas_area_name_norwegian,
       {steady('sum(co2_tonnes)', 'co2', 5)}, {steady('sum(fuel_tonnes)', 'fuel', 5)}
FROM starred GROUP BY {_star_keys}, {_ECO}_area_name, management_plan_marine_areas_area_name_norwegian, {_raw_keys}
"""
_svalbard = f"coalesce({_ECO}_id IN ({', '.join(repr(z) for z in config.SVALBARD_ZONES)}), false)"
PARTS["moved"] = f"""
SELECT * REPLACE (CASE WHEN {_svalbard} THEN 'Svalbard' ELSE county_name END AS county_name,
  CASE WHEN {_svalbard} THEN '-99' ELSE county_id END AS county_id,
  CASE WHEN {_svalbard} THEN 'Svalbard' ELSE municipality_name END AS municipality_name,
  CASE WHEN {_svalbard} THEN '-9999' ELSE municipality_id END AS municipality_id), municipality_id AS true_municipality
FROM starred
"""
FINAL["area_override"] = f"""
SELECT {_ECO}_id, county_id, county_name, municipality_id, municipality_name, count(*) AS n_rows
FROM (SELECT DISTINCT {_star_keys}, true_municipality, management_plan_marine_areas_area_name_norwegian, {_raw_keys}
      FROM moved) AS d
GROUP BY ALL
"""
_report_keys = ", ".join("vessel_class AS vessel_type" if key == "vessel_type" else key for key in REPORT_KEYS)
PARTS["report"] = f"""
SELECT {_report_keys}, CAST(sum(delta_previous_point_seconds) AS BIGINT) AS sum_seconds,
       {half_up('sum(main_engine_kwh) + sum(aux_kwh) + sum(boiler_kwh)', 4)} AS sum_kwh,
       {half_up('sum(aux_kwh * (1 - electric_shore_power_at_berth_reduction_factor))', 4)} AS sum_aux_kwh_shore_power,
       {half_up('sum(boiler_kwh * (1 - electric_shore_power_at_berth_reduction_factor))', 4)} AS sum_boiler_kwh_shore_power,
       sum(fuel_tonnes) AS sum_fuel, {', '.join(f'sum({g}_tonnes) AS sum_{g}' for g in GASES)},
       {half_up('sum(distance_previous_point_meters) / 1000', 2)} AS distance_kilometers
FROM moved GROUP BY ALL
"""


def _steady_sums(names, default: int, renames: dict[str, str] | None = None) -> str:
    return ", ".join(steady(n, places=min(default, REPORT_PLACES.get(n, default))) for n in names)


_sums = ("sum_kwh", "sum_fuel", *(f"sum_{g}" for g in GASES), "distance_kilometers")
FINAL["emission_report"] = f"""
SELECT * REPLACE ({_steady_sums((*_sums, 'sum_aux_kwh_shore_power', 'sum_boiler_kwh_shore_power'), 5)}) FROM report
"""


def _rollup(name: str) -> str:
    return f"{half_up(f'sum({name})', 4)} AS {name}" if name.removeprefix("sum_") in GASES else f"sum({name}) AS {name}"


_published = f"version = '{config.VERSION}' AND in_coast_and_sea_area AND year_month < '{THIS_MONTH}'"
_view_keys = ", ".join(
    key for key in REPORT_KEYS
    if key not in ("imo", "shipname", "statcode5", "shiptypelevel5", "month", "sail_id", "municipality_voyage_route")
)
FINAL["report_view"] = f"""
SELECT * REPLACE ({_steady_sums(_sums, 3)}) FROM (
  SELECT {_view_keys}, CAST(sum(sum_seconds) AS BIGINT) AS sum_seconds, {', '.join(_rollup(n) for n in _sums)}
  FROM report WHERE {_published} GROUP BY ALL) AS v
"""
PARTS["sails"] = f"""
SELECT sail_id, municipality_voyage_route, vessel_type, gt_group, min(year_month) AS year_month,
       sum(sum_seconds) AS sum_seconds, {', '.join(f'sum({n}) AS {n}' for n in _sums)}
FROM report WHERE {_published} AND municipality_voyage_route IS NOT NULL
GROUP BY sail_id, municipality_voyage_route, vessel_type, gt_group
"""
PARTS["ranked_routes"] = """
SELECT municipality_voyage_route, sum(sum_co2e) AS co2e_route_total,
       row_number() OVER (ORDER BY sum(sum_co2e) DESC, municipality_voyage_route) AS rank
FROM sails GROUP BY municipality_voyage_route
"""
FINAL["top_routes"] = f"""
SELECT * REPLACE ({_steady_sums((*_sums, 'co2e_route_total'), 3)}) FROM (
  SELECT s.municipality_voyage_route, rank, co2e_route_total, vessel_type, gt_group, left(year_month, 4) AS year, year_month,
         count(DISTINCT sail_id) AS count_sails, CAST(sum(sum_seconds) AS BIGINT) AS sum_seconds,
         {', '.join(_rollup(n) for n in _sums)}
  FROM sails AS s JOIN ranked_routes AS r ON r.municipality_voyage_route = s.municipality_voyage_route
  WHERE rank <= 100 GROUP BY ALL) AS t
"""
# The registered views are read today, when every month of the data is over.
_every_month = _published.replace(f" AND year_month < '{THIS_MONTH}'", "")
FINAL["registered_report_view"] = FINAL["report_view"].replace(_published, _every_month)
PARTS["all_sails"] = PARTS["sails"].replace(_published, _every_month)
PARTS["all_ranked_routes"] = PARTS["ranked_routes"].replace("FROM sails", "FROM all_sails")
FINAL["registered_top_routes"] = (
    FINAL["top_routes"].replace("FROM sails", "FROM all_sails").replace("JOIN ranked_routes", "JOIN all_ranked_routes")
)
FINAL["monthly_vessel_co2"] = f"""
SELECT vessel_id, strftime(date_time_utc, '%Y-%m') AS year_month, {steady('sum(co2_tonnes)', 'co2_tonnes', 5)},
       {steady('sum(main_engine_kwh)', 'main_engine_kwh', 5)} FROM fact GROUP BY 1, 2
"""

# ---------------------------------------------------------------- incremental

FINAL["pending_dates"] = f"SELECT {text('date_utc')} FROM stats WHERE ais_voyages IS NOT NULL AND emission IS NULL"
PARTS["runs"] = """
SELECT date_utc, sum(CASE WHEN gap IS NULL OR gap > 1 THEN 1 ELSE 0 END) OVER (ORDER BY date_utc) AS run
FROM (SELECT date_utc, date_diff('day', lag(date_utc) OVER (ORDER BY date_utc), date_utc) AS gap
      FROM (SELECT DISTINCT date_utc FROM stats WHERE emission IS NOT NULL) AS d) AS g
"""
PARTS["chunks"] = "SELECT *, (row_number() OVER (PARTITION BY run ORDER BY date_utc) - 1) // 90 AS chunk FROM runs"
FINAL["date_ranges"] = f"""
SELECT {text('min(date_utc)', 'start_date')}, {text('max(date_utc)', 'end_date')}, count(*) AS n_dates
FROM chunks GROUP BY run, chunk
"""
PARTS["high_water"] = "SELECT max(strftime(date_utc, '%Y-%m')) AS top FROM ais WHERE date_utc < DATE '1997-06-15'"
PARTS["done"] = """
SELECT date_utc, CAST(month(date_utc) AS INTEGER) AS month, CAST(year(date_utc) AS INTEGER) AS year
FROM stats CROSS JOIN high_water
WHERE emission IS NOT NULL AND (top IS NULL OR strftime(date_utc, '%Y-%m') > top)
"""
FINAL["watermark_dates"] = f"SELECT {text('date_utc')}, month, year FROM done"
PARTS["month_days"] = """
SELECT year, month, count(DISTINCT day(date_utc)) AS days_count, min(date_utc) AS s, max(date_utc) AS e
FROM done GROUP BY year, month
"""
FINAL["days_in_month"] = f"SELECT year, month, days_count, {text('s', 'start_date')}, {text('e', 'end_date')} FROM month_days"
FINAL["complete_months"] = f"""
SELECT {text('CAST(d AS DATE)', 'date_utc')} FROM (
  SELECT unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM month_days
  WHERE days_count >= CASE WHEN month IN (1, 3, 5, 7, 8, 10, 12) THEN 31 WHEN month IN (4, 6, 9, 11) THEN 30
    WHEN year % 4 = 0 AND (year % 100 <> 0 OR year % 400 = 0) THEN 29 ELSE 28 END) AS x
"""
FINAL["quarters"] = """
SELECT CAST(y AS INTEGER) AS year, y || start_day AS start_date, y || end_day AS end_date
FROM (SELECT DISTINCT year(date_utc) AS y FROM stats) AS years
CROSS JOIN (VALUES ('-01-01', '-03-31'), ('-04-01', '-06-30'), ('-07-01', '-09-30'), ('-10-01', '-12-31')) AS q(start_day, end_day)
"""
FINAL["job_stats"] = f"""
SELECT {text('coalesce(s.date_utc, u.date_utc)', 'date_utc')}, {moment('s.ais_voyages', 'ais_voyages')},
       {moment(f"CASE WHEN u.date_utc IS NOT NULL THEN TIMESTAMP '{STAMP}' ELSE s.emission END", 'emission')}
FROM stats AS s FULL JOIN (SELECT DISTINCT date_utc FROM ais) AS u ON u.date_utc = s.date_utc
"""

# ---------------------------------------------------------------- ingest and tables

FINAL["ingest_variables"] = f"""
SELECT variable, value, {text('start_date')}, {text('end_date')}, false AS rescued FROM typed
"""
FINAL["ingest_vessel_type"] = "SELECT statcode5, nullif(vessel_type, '') AS vessel_type FROM vessel_types"
FINAL["ingest_aux_boiler"] = """
SELECT vessel_type, size_bin, unit, low_limit, boiler_berth, aux_berth,
       CASE WHEN size_bin = 3 THEN -1 ELSE aux_cruise END AS aux_cruise, size_bin = 3 AS rescued
FROM bins_raw
"""
FINAL["ingest_battery"] = f"""
SELECT {text('mmsi')}, route, {steady("CAST(TRY_CAST(replace(degree_of_electrification, ',', '.') AS FLOAT) AS DOUBLE)",
                                      'degree_of_electrification', 4)},
       coalesce(TRY_CAST(replace('1 ' || battery_pack_kwh, ' ', '') AS INTEGER), -1) AS battery_pack_kwh
FROM battery_raw
"""
FINAL["csv_batch"] = f"""
SELECT mmsi, imo, vessel_name, route, degree_of_electrification, battery_pack_kwh, {text('start_date')}, {text('end_date')},
       'vessel_battery' AS bi_source FROM battery_raw
"""
_by_date = f"""
SELECT {text('date_utc')}, version, count(*) AS n_rows, {steady('sum(co2_tonnes)', 'co2_tonnes', 5)},
       {steady('sum(aux_kwh)', 'aux_kwh', 3)}
FROM fact GROUP BY fact.date_utc, version
"""
for _name in ("fact_write", "purge_version", "compact"):
    FINAL[_name] = _by_date
FINAL["report_job"] = FINAL["purge_report"] = FINAL["report_write"] = f"""
SELECT year_month, version, count(*) AS n_rows, CAST(sum(sum_seconds) AS BIGINT) AS sum_seconds,
       {steady('sum(sum_co2)', 'sum_co2', 4)} FROM report GROUP BY year_month, version
"""

# ---------------------------------------------------------------- assembly

_SOURCES = {**{name: re.sub(r"\{(\w+)\}", r"\1", sql).replace("`", '"') for name, sql in inputs.SQL.items()}, **PARTS}


def _used(sql: str) -> list[str]:
    return [name for name in _SOURCES if re.search(rf"\b(?:FROM|JOIN|IN \(SELECT vessel_id FROM) {name}\b", sql)]


def _collect(sql: str, found: list[str]) -> None:
    for name in _used(sql):
        if name not in found:
            _collect(_SOURCES[name], found)
            found.append(name)


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query name."""
    texts = {}
    for name, final in FINAL.items():
        parts: list[str] = []
        _collect(final, parts)
        ctes = ",\n".join(f"{part} AS MATERIALIZED ({_SOURCES[part].strip()})" for part in parts)
        texts[name] = f"WITH {ctes}\n{final.strip()}" if parts else final.strip()
    return texts
