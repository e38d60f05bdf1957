"""The register build: sources to the vessel dimension."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame

from shipflux.operators import register, sinks


class RegisterInputs(NamedTuple):
    """Tables the register build reads; `bins` is the prepared size-bin table."""

    ships: DataFrame
    identities: DataFrame
    ship_data: DataFrame
    main_engines: DataFrame
    battery: DataFrame
    vessel_types: DataFrame
    bins: DataFrame


def merged_register(inputs: RegisterInputs) -> DataFrame:
    engines = register.engine_register(inputs.ship_data, inputs.main_engines)
    return register.merge_registers(
        inputs.ships, inputs.identities, engines, inputs.battery, inputs.vessel_types
    )


def vessel_dimension(inputs: RegisterInputs) -> DataFrame:
    return register.build_vessel_dimension(merged_register(inputs), inputs.bins)


def run(inputs: RegisterInputs, historical_path: str, current_path: str, today: Column | None = None) -> None:
    """Write the historical dimension, check its row count, and write the current part.

    The current part is taken from the written table, so the register is built once.
    """
    spark = inputs.ships.sparkSession
    sinks.write_dimension(vessel_dimension(inputs), historical_path, "vessel_id", "start_date", "end_date")
    written = spark.read.parquet(historical_path)
    register.check_row_counts(inputs.ships, inputs.identities, inputs.battery, written)
    sinks.write_dimension(register.current_vessels(written, today), current_path, "vessel_id")
