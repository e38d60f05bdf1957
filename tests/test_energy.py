"""Cut-off values of load, energy, low-load bins and shore power."""

import pytest
from shipflux.operators import emissions, energy, fuel, parameters, shore_power

BASE = {
    "speed_over_ground": 10.0, "speed_service": 20.0, "phase": "c", "main_engine_kw": 1000.0,
    "delta_previous_point_seconds": 3600, "sail_time_remaining_seconds": 0, "vessel_class": "Stykkgods",
    **{f"{e}_{m}_kw": p for e, base in (("aux", 100), ("boiler", 10))
       for m, p in zip(("berth", "anchor", "maneuver", "cruise"), (base, base * 2, base * 3, base * 4))},
}
SCHEMA = (
    "speed_over_ground double, speed_service double, phase string, main_engine_kw double, "
    "delta_previous_point_seconds long, sail_time_remaining_seconds long, vessel_class string, "
    + ", ".join(f"{e}_{m}_kw int" for e in ("aux", "boiler") for m in ("berth", "anchor", "maneuver", "cruise"))
)


def calculated(spark, **changes):
    row = {**BASE, **changes}
    return energy.with_energy(spark.createDataFrame([row], SCHEMA)).first()


@pytest.mark.parametrize(
    "changes, load",
    [({}, 0.125), ({"speed_over_ground": 40.0}, 0.98), ({"speed_service": -99.0}, 0.0), ({"speed_service": 0.0}, None),
     ({"speed_over_ground": None}, None), ({"speed_over_ground": None, "phase": "n"}, 0.0), ({"phase": "a"}, 0.0),
     ({"phase": "dp-o", "speed_over_ground": 0.0}, 0.1), ({"phase": "dp-o", "speed_over_ground": None}, None)],
)
def test_load(spark, changes, load):
    assert calculated(spark, **changes)["main_engine_load_factor"] == load


@pytest.mark.parametrize(
    "changes, aux, boiler",
    [({}, 400.0, 40.0), ({"phase": "aq"}, 300.0, 30.0), ({"phase": "x"}, 0.0, 0.0), ({"main_engine_kw": 150.0}, 0.0, 0.0),
     ({"main_engine_kw": 150.5}, 7.525, 40.0), ({"main_engine_kw": 500.0}, 25.0, 40.0), ({"main_engine_kw": 500.1}, 400.0, 40.0),
     ({"main_engine_kw": -99.0}, 400.0, 40.0), ({"aux_cruise_kw": None}, None, 40.0),
     ({"phase": "n", "sail_time_remaining_seconds": 86399}, 100.0, 10.0),
     ({"phase": "n", "sail_time_remaining_seconds": 86400}, 75.0, 7.5),
     ({"phase": "n", "sail_time_remaining_seconds": 172799, "vessel_class": "Oljetanker"}, 100.0, 10.0),
     ({"phase": "n", "sail_time_remaining_seconds": 172800, "vessel_class": "Oljetanker"}, 100 / 3, 10 / 3)],
)
def test_aux_and_boiler_energy(spark, changes, aux, boiler):
    row = calculated(spark, **changes)
    assert row["aux_kwh"] == (None if aux is None else pytest.approx(aux))
    assert row["boiler_kwh"] == pytest.approx(boiler)


def test_low_load_bins_are_left_open(spark):
    loads = [None, 0.0, 0.0001, 0.00011, 0.02, 0.0200001, 0.07, 0.1, 0.19, 0.1900001, 0.98]
    rows = spark.createDataFrame([(load,) for load in loads], "main_engine_load_factor double")
    bins = [row[0] for row in rows.select(emissions.low_load_bin()).collect()]
    assert bins == [0, 0, 0, 1, 1, 2, 6, 9, 18, 0, 0]


def test_low_load_names():
    names = parameters.low_load_bin_names()
    assert len(names) == 18 and names[0] == "00001_002" and names[8] == "009_01" and names[9] == "01_011"


def test_shore_power_needs_a_stay_above_two_hours(spark):
    schema = (
        "close_to_power boolean, phase string, sail_time_remaining_seconds long, "
        "usage_percentage_vessel_port_electric double, usage_percentage_vessel_type_port_electric double, "
        "shore_power_usage_percentage double"
    )
    rows = [
        (True, "n", 7200, 0.5, None, None), (True, "n", 7201, None, 0.254, 0.9), (True, "n", 7201, None, None, None),
        (False, "n", 9999, 0.5, None, None), (True, "a", 9999, 0.5, None, None),
    ]
    found = shore_power.with_shore_power(spark.createDataFrame(rows, schema)).collect()
    assert [(r["electric_shore_power_at_berth_reduction_factor"], r["phase"]) for r in found] == [
        (1.0, "n"), (0.75, "p"), (None, "p"), (1.0, "n"), (1.0, "a")
    ]


def test_unknown_parts_count_as_zero_in_sums(spark):
    rows = spark.createDataFrame([(1.0, None, 2.0), (None, None, None)], "a double, b double, c double")
    sums = rows.select(fuel.sum_known(["a", "b", "c"])).collect()
    assert [row[0] for row in sums] == [3.0, 0.0]
