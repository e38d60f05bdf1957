"""Job inputs derived from the given tables.

Each input is one SQL text that Spark and DuckDB both understand, so the queries
and their oracle start from the same rows. Integer arithmetic on keys only; every
position rule is row-local, so no busy ship is ever collected for it.
`{name}` stands for a given table.
"""

from __future__ import annotations

import re

from shipflux.config import SVALBARD_ZONES
from shipflux.operators.parameters import required_names
from shipflux.operators.register import PROPULSION_CODES

FUEL_CODES = ("LG", "GB", "LP", "RF", "DF", "CU", "NU", "HY", "ME", "NN", "UU", "YY")
DRIVES = (*PROPULSION_CODES, "Rowing", None)
SHIP_TYPES = (
    "Container", "Liquefied gas tanker", "Oil tanker", "Cruise", "Miscellaneous - fishing",
    "Ferry-RoPax", "Bulk carrier",
)
SHIP_CLASSES = ("Cruise", "Gasstankskip", "Oljetanker", "Stykkgods", "Fiskefartoy", "", "Unknown")
PHASES = ("a", "aq", "c", "dp-o", "f", "m", "n", "n")
VOYAGES = ("Berthed", "Domestic", "International out", "International in", "Transit")
MODELS = ("6S50DF", "X72", "5G70ME-GA", "7S60ME-C", "W20", "B35", None)
BUILDERS = ("Rolls-Royce Marine AS - Norway", "Bergen Engines AS - Norway", "MAN", None)

LOW_18, LOW_24 = (1 << 18) - 1, (1 << 24) - 1


def pick(index: str, values) -> str:
    """CASE that takes element `index` modulo the number of values."""
    arms = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v))
        for i, v in enumerate(values)
    )
    return f"(CASE ({index}) % {len(values)} {arms} END)"


def cell_base(resolution: int) -> int:
    return (1 << 59) | (resolution << 52) | (8 << 45)


def digits(upto: int) -> str:
    return " + ".join(f"d{r} * {1 << (3 * (15 - r))}" for r in range(4, upto + 1))


def text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


TOWN_NO = "d6 * 4 + (CASE d9 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END)"


def town_id(number: str) -> str:
    return f"lpad({text(f'({number}) % 5 + 3')}, 2, '0') || lpad({text(number)}, 2, '0')"


SQL: dict[str, str] = {}

SQL["raw_points"] = """
SELECT l_orderkey AS k, l_partkey AS p, CAST(l_linenumber AS BIGINT) AS n, l_quantity AS q,
       CAST(l_shipdate AS TIMESTAMP) AS day, CAST(floor(3 * l_partkey / 4) AS BIGINT) AS v,
       l_orderkey % 3 AS d4, l_partkey % 3 AS d5, CAST(floor(3 * l_partkey / 4) AS BIGINT) % 7 AS d6,
       l_orderkey % 7 AS d7, (l_orderkey + l_partkey) % 7 AS d8, CAST(l_linenumber AS BIGINT) % 7 AS d9
FROM {lineitem}
"""

SQL["ais"] = f"""
SELECT {text('k')} || '-' || {text('n')} || '-' || {text('p')} AS id,
       CAST(v AS INT) AS vessel_id, 257000000 + v AS mmsi,
       day + INTERVAL '3' HOUR * CAST((k + n) % 8 AS INT) AS date_time_utc,
       CAST(day AS DATE) AS date_utc,
       {cell_base(14)} + {digits(9)} + 7 AS hex_14,
       CASE WHEN k % 23 = 0 THEN NULL ELSE 's' || {text('v')} || '-' || {text('year(day)')} END AS sail_id,
       'POINT (' || {text('k % 180')} || ' ' || {text('p % 90')} || ')' AS geometry_wkt,
       CASE WHEN k % 61 = 0 THEN NULL ELSE q * CAST(0.43 AS DOUBLE) END AS speed_over_ground,
       {pick('k + p', PHASES)} AS phase,
       (k * 9973 + p) % 259200 AS sail_time_remaining_seconds,
       60 + (k * 37 + n) % 1740 AS delta_previous_point_seconds,
       q * CAST(0.22 AS DOUBLE) * (60 + (k * 37 + n) % 1740) AS distance_previous_point_meters,
       {text('k % 50')} AS new_ship_rep_location_id, 'Loc ' || {text('k % 50')} AS new_ship_rep_location_name,
       'C' || {text('k % 9')} AS unlocode_country_code, 'L' || {text('p % 90')} AS unlocode_location_code,
       'City ' || {text('p % 90')} AS unlocode_city,
       'C' || {text('k % 9')} AS country_start, 'C' || {text('p % 9')} AS country_end,
       {pick('k', VOYAGES)} AS voyage_type, k % 5 <> 0 AS in_coast_and_sea_area,
       n % 2 = 0 AS ais_public_data, (k + p) % 8 IN (0, 6, 7) AS ship_is_stopped,
       {text('n')} AS msg_type
FROM raw_points
"""

SQL["cells"] = f"""
SELECT DISTINCT d4, d5, d6, d7, d8, d9,
       {cell_base(7)} + {digits(7)} + {LOW_24} AS hex_7, {cell_base(9)} + {digits(9)} + {LOW_18} AS hex_9
FROM raw_points
"""
SQL["cells_7"] = "SELECT DISTINCT d4, d5, d6, d7, hex_7 FROM cells"

SQL["layer_eca"] = f"""
SELECT 'eca-' || {text('d6')} AS id, hex_7 FROM cells_7 WHERE d7 % 2 = 0
UNION ALL SELECT 'eca-x' || {text('d5')} AS id, hex_7 FROM cells_7 WHERE d7 = 0
"""
SQL["layer_plan"] = f"""
SELECT CAST(d6 AS INT) AS area_id, 'Plan ' || {text('d6')} AS area_name_norwegian, hex_7 FROM cells_7 WHERE d7 <> 3
UNION ALL
SELECT CAST(d6 + 1 AS INT) AS area_id, 'Plan ' || {text('d6 + 1')} AS area_name_norwegian, hex_7
FROM cells_7 WHERE d7 = 1
"""
SQL["layer_zone"] = f"""
SELECT CASE WHEN d7 < 4 AND d8 = 0 THEN {pick('d7', SVALBARD_ZONES)} ELSE 'zone-' || {text('d6')} END AS id,
       CASE WHEN d7 < 4 AND d8 = 0 THEN 'Part ' || {text('d7')} ELSE 'Zone ' || {text('d6')} END AS area_name, hex_9
FROM cells WHERE d8 <> 5
UNION ALL SELECT 'azone-' || {text('d7')} AS id, 'A zone ' || {text('d7')} AS area_name, hex_9 FROM cells WHERE d9 = 3
"""
SQL["layer_shelf"] = f"SELECT 'shelf-' || {text('d6')} AS id, hex_9 FROM cells WHERE d9 < 5"
SQL["layer_town"] = "\nUNION ALL\n".join(
    f"""SELECT {town_id(f'{TOWN_NO} + {2024 - year}')} AS municipality_id,
       'By ' || {text(f'{TOWN_NO} + {2024 - year}')} AS municipality_name_no, {year} AS year, hex_9
FROM cells WHERE d8 <> 6"""
    for year in (2024, 2023)
)
SQL["installations"] = f"""
SELECT 'a' || {text('d6')} || {text('d7')} || {text('d8')} AS bi_row_sha, CAST(1996 + d7 % 6 AS INT) AS year,
       CASE WHEN d8 = 2 THEN NULL ELSE CAST(d8 * 15 AS DOUBLE) / 100 END AS usage_percentage,
       hex_9 AS hex_kring_9_1, 1 AS hex_kring_distance_9_1 FROM cells WHERE d9 < 4
UNION ALL
SELECT 'b' || {text('d6')} || {text('d5')} AS bi_row_sha, 1999 AS year, CAST(d7 AS DOUBLE) / 10 AS usage_percentage,
       hex_9 AS hex_kring_9_1, 0 AS hex_kring_distance_9_1 FROM cells WHERE d9 < 2
UNION ALL
SELECT 'A' || {text('d6')} || {text('d4')} AS bi_row_sha, CAST(1996 + d7 % 6 AS INT) AS year,
       CAST(0.3 AS DOUBLE) AS usage_percentage, hex_9 AS hex_kring_9_1, 1 AS hex_kring_distance_9_1
FROM cells WHERE d9 = 1 AND d5 = 1
"""


def missing(every: int, at: int, value: str, key: str = "v") -> str:
    return f"CASE WHEN {key} % {every} = {at} THEN NULL ELSE {value} END"


def double(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


SQL["ships"] = f"""
SELECT CAST(v AS INT) AS vessel_id, {text('257000000 + v')} AS mmsi_text,
       {missing(13, 0, double('9000000 + v'))} AS imo,
       {missing(29, 5, text('9000000 + v'))} AS fairplay_id,
       {missing(17, 0, "'CS' || " + text('v'))} AS call_sign, name AS ship_name,
       {missing(19, 0, "'N' || " + text('nation'))} AS flag_code,
       CASE WHEN v % 16 = 7 THEN NULL WHEN v % 16 = 15 THEN 'Tug' ELSE {pick('v % 8', SHIP_TYPES)} END
         AS vessel_type_imo_ghg,
       {missing(37, 0, "'S' || " + text('v % 40'))} AS statcode5, 'Type ' || {text('v % 5')} AS ship_type,
       {missing(11, 3, double('1890 + (v * 37) % 135'))} AS year_of_build,
       {missing(11, 0, double('(v * 7919) % 120000'))} AS gt,
       {missing(11, 1, double('(v * 104729) % 230000'))} AS dwt,
       {missing(11, 2, double('(v * 31) % 15000'))} AS teu,
       CASE WHEN v % 3 = 0 THEN {double('(v * 211) % 90000')} ELSE NULL END AS liquid_capacity,
       {missing(7, 1, double('(v * 127) % 90000'))} AS gas_capacity,
       {missing(11, 4, double('(v * 13) % 260'))} AS length_overall,
       {missing(11, 5, double('v % 40'))} AS breadth_moulded, {missing(11, 6, double('v % 15'))} AS draught,
       {double(pick('v', (None, 0, 100, 129, 130, 300, 720, 900, 1999, 2000, 2400)))} AS main_engine_rpm,
       CASE v % 6 WHEN 0 THEN NULL WHEN 1 THEN {double('120')} WHEN 2 THEN {double('150')} WHEN 3 THEN {double('400')}
         WHEN 4 THEN {double('499 + v % 3')} ELSE {double('1000 + (v * 7) % 30000')} END AS power_kw_max,
       {double(pick('v', (2, 4, 4, 2, None)))} AS main_engine_stroke_type,
       CASE WHEN v % 23 = 0 THEN NULL WHEN v % 31 = 0 THEN {double('0')} ELSE {double('8 + v % 17')} END AS speed_service,
       {missing(23, 1, double('10 + v % 17'))} AS speed_max
FROM (SELECT c_custkey AS v, c_name AS name, c_nationkey AS nation FROM {{customer}}) AS c
"""
SQL["identities"] = """
SELECT CAST(c_custkey AS INT) AS vessel_id, CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE 9000000 + c_custkey END AS imo,
       CASE WHEN c_custkey % 25 = 0 THEN 776000000 ELSE 257000000 END + c_custkey AS mmsi,
       CASE WHEN c_custkey % 21 = 0 THEN 2 ELSE 1 END AS row_number_mmsi_imo
FROM {customer}
UNION ALL
SELECT CAST(c_custkey AS INT) AS vessel_id, 9000000 + c_custkey AS imo, 300000000 + c_custkey AS mmsi,
       1 AS row_number_mmsi_imo
FROM {customer} WHERE c_custkey % 10 = 3
"""
SQL["ship_data"] = "\nUNION ALL\n".join(
    f"""SELECT {text('9000000 + c_custkey')} AS lrimoshipno, {pick(f'c_custkey + {shift}', FUEL_CODES)} AS fueltype1code,
       {pick(f'CAST(floor(c_custkey / 12) AS BIGINT) + {shift}', FUEL_CODES)} AS fueltype2code,
       CASE c_custkey % 13 WHEN 0 THEN 'Gas' WHEN 1 THEN 'Turbine' WHEN 2 THEN 'Reciprocatng' ELSE 'Oil' END
         AS MainEngineType,
       {pick('c_custkey * 7', DRIVES)} AS propulsiontype, {ended} AS `__END_AT`
FROM {{customer}} {where}"""
    for shift, ended, where in (
        (0, "CAST(NULL AS TIMESTAMP)", ""),
        (1, "CAST('2020-01-01' AS TIMESTAMP)", "WHERE c_custkey % 6 = 0"),
    )
)
SQL["main_engines"] = "\nUNION ALL\n".join(
    f"""SELECT {text('9000000 + c_custkey')} AS lrno, {pick(f'c_custkey * {position} + 1', BUILDERS)} AS enginebuilder,
       {pick(f'c_custkey + {position}', MODELS)} AS enginemodel, {position} AS Position
FROM {{customer}} WHERE c_custkey % {position + 1} <> {position % 2}"""
    for position in (1, 2, 3)
)
SQL["vessel_types"] = f"""
SELECT DISTINCT 'S' || {text('c_custkey % 40')} AS statcode5, {pick('c_custkey % 40', SHIP_CLASSES)} AS vessel_type
FROM {{customer}} WHERE c_custkey % 40 <> 12
"""
SQL["battery_raw"] = f"""
SELECT 257000000 + c_custkey AS mmsi, CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 9000000 + c_custkey END AS imo,
       c_name AS vessel_name, CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE 'Route ' || {text('c_custkey % 7')} END AS route,
       CASE WHEN c_custkey % 45 = 4 THEN 'x0,5' ELSE '0,' || {text('c_custkey % 8 + 1')} END AS degree_of_electrification,
       CASE WHEN c_custkey % 4 = 0 THEN 'n/a' ELSE {text('c_custkey * 10')} END AS battery_pack_kwh,
       CAST('1997-01-01' AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date
FROM {{customer}} WHERE c_custkey % 9 = 4
UNION ALL
SELECT 257000000 + c_custkey, 9000000 + c_custkey, c_name, 'null', '0,25', '50',
       CAST('1995-06-01' AS DATE), CAST('1996-12-31' AS DATE)
FROM {{customer}} WHERE c_custkey % 18 = 4
UNION ALL
SELECT 257000000 + c_custkey, 9000000 + c_custkey, c_name, 'Again', '0,75', '60',
       CAST('1997-01-01' AS DATE), CAST('1999-12-31' AS DATE)
FROM {{customer}} WHERE c_custkey % 27 = 4
"""
SQL["vessel_port_raw"] = f"""
SELECT c_name AS ship_name, 9000000 + c_custkey AS imo, 257000000 + c_custkey AS mmsi,
       CASE WHEN c_custkey % 40 = 2 THEN 'null' ELSE 'Town ' || {text('(c_custkey % 7) * 4')} END AS municipality_name,
       '0,' || {text('c_custkey % 9')} AS usage_percentage,
       CAST('1996-01-01' AS DATE) AS start_date, CAST(NULL AS DATE) AS end_date
FROM {{customer}} WHERE c_custkey % 5 = 2
UNION ALL
SELECT c_name, 9000000 + c_custkey, 257000000 + c_custkey, 'Town ' || {text('(c_custkey % 7) * 4')}, '1',
       CAST('1998-01-01' AS DATE), CAST('1998-12-31' AS DATE)
FROM {{customer}} WHERE c_custkey % 20 = 2
"""
SQL["type_port_raw"] = f"""
SELECT t.vessel_type AS vessel_type, 'Town ' || {text('n_nationkey')} AS municipality_name,
       CASE WHEN n_nationkey % 6 = 0 THEN 'half' ELSE '0,' || {text('n_nationkey % 9')} END AS usage_percentage,
       CASE WHEN n_nationkey % 7 = 3 THEN NULL ELSE CAST('1997-06-01' AS DATE) END AS start_date,
       CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST('2000-06-30' AS DATE) END AS end_date
FROM {{nation}} JOIN (SELECT DISTINCT vessel_type FROM vessel_types) AS t
  ON length(t.vessel_type) % 2 = n_nationkey % 2
UNION ALL
SELECT 'Zeppelin ' || {text('n_nationkey')}, 'Atlantis ' || {text('n_regionkey')}, '0,1',
       CAST('1997-06-01' AS DATE), CAST(NULL AS DATE)
FROM {{nation}}
"""
SQL["municipalities"] = "\nUNION ALL\n".join(
    f"""SELECT {town_id(f'n_nationkey + {2024 - year}')} AS municipality_no,
       'Town ' || {text(f'n_nationkey + {2024 - year}')} AS municipality_name,
       'By ' || {text(f'n_nationkey + {2024 - year}')} AS municipality_name_no, {year} AS year
FROM {{nation}}"""
    for year in (2024, 2023)
)
SQL["counties"] = "\nUNION ALL\n".join(
    f"""SELECT lpad({text('r_regionkey + 3')}, 2, '0') AS fylkesnummer, r_name || ' {year}' AS navn_norsk, {year} AS year
FROM {{region}} WHERE r_regionkey <> 4"""
    for year in (2024, 2023)
)
SQL["ship_names"] = f"""
SELECT CAST(c_custkey AS INT) AS csid, 'MV ' || {text('c_custkey')} AS shipname,
       'Level ' || {text('c_custkey % 6')} AS shiptypelevel5
FROM {{customer}} WHERE c_custkey % 4 <> 3
"""
SQL["bins_raw"] = f"""
SELECT t.vessel_type AS vessel_type, CAST(length(t.vessel_type) AS INT) AS vessel_type_id, low_limit, high_limit, size_bin,
       {pick('length(t.vessel_type)', ('gt', 'dwt', 'teu', 'cbm'))} AS unit,
       size_bin * 10 + batch AS boiler_berth, size_bin * 11 + batch AS boiler_anchor,
       size_bin * 12 + batch AS boiler_maneuver, size_bin * 13 + batch AS boiler_cruise,
       size_bin * 100 + batch AS aux_berth, size_bin * 110 + batch AS aux_anchor,
       size_bin * 120 + batch AS aux_maneuver, size_bin * 130 + batch AS aux_cruise,
       CASE batch WHEN 1 THEN CAST('2024-01-01 10:00:00' AS TIMESTAMP) ELSE CAST('2024-02-01 10:00:00' AS TIMESTAMP) END
         AS bi_ingested_timestamp
FROM (SELECT DISTINCT vessel_type_imo_ghg AS vessel_type, 1 AS one FROM ships) AS t
JOIN (SELECT * FROM (VALUES (1, 1, 0, 1000), (1, 2, 1000, 10000), (1, 3, 10000, 40000), (1, 4, 40000, NULL))
      AS b(one, size_bin, low_limit, high_limit)) AS b ON b.one = t.one
JOIN (SELECT * FROM (VALUES (1, 1), (1, 2)) AS r(one, batch)) AS r ON r.one = t.one
"""
SQL["stats"] = """
SELECT CAST(o_orderdate AS DATE) AS date_utc,
       CASE WHEN (day(o_orderdate) + 31 * month(o_orderdate)) % 50 = 0 THEN NULL
            ELSE CAST(max(o_orderdate) AS TIMESTAMP) + INTERVAL '1' DAY END AS ais_voyages,
       CASE WHEN month(o_orderdate) % 4 = 0 AND day(o_orderdate) % 3 = 0 THEN NULL
            ELSE CAST(max(o_orderdate) AS TIMESTAMP) + INTERVAL '2' DAY END AS emission
FROM {orders} GROUP BY o_orderdate
"""
# Values grow with the alphabetical place of the name. Their long decimals keep results
# away from round values, where two engines may round differently.
SQL["parameter_values"] = (
    "SELECT variable, CAST(place AS DOUBLE) * CAST(0.10137182843 AS DOUBLE) AS value FROM (VALUES "
    + ", ".join(f"('{name}', {place})" for place, name in enumerate(required_names(), start=1))
    + ") AS t(variable, place)"
)
SQL["deliveries"] = f"""
SELECT 'v' || {text('CAST(floor(o_custkey / 10) AS BIGINT)')} AS variable,
       CASE WHEN o_custkey % 50 = 0 THEN 'bad' ELSE {text('o_orderkey % 2')} || ',' || {text('o_custkey % 2')} END AS value,
       '01.01.' || {text('year(o_orderdate)')} AS start_date,
       CASE WHEN o_custkey % 30 < 10 THEN NULL ELSE '31.12.' || {text('year(o_orderdate) + 1')} END AS end_date,
       CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' HOUR * CAST(o_orderkey % 5 AS INT) AS bi_ingested_timestamp
FROM {{orders}}
"""


def needed(name: str) -> list[str]:
    """`name` and every input it builds on, in order."""
    found: list[str] = []

    def visit(item: str) -> None:
        for other in SQL:
            if other != item and re.search(rf"\b(FROM|JOIN) {other}\b", SQL[item]) and other not in found:
                visit(other)
        if item not in found:
            found.append(item)

    visit(name)
    return found
