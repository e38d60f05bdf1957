"""Area layers keyed by H3 cell, and their joins to positions."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipflux import config
from shipflux.functions.cells import parent_cell
from shipflux.functions.keyed import small_side


class Layer(NamedTuple):
    """How one area layer is read; `select` lists source columns, the id first."""

    name: str
    resolution: int
    select: tuple[str, ...]
    where: str | None = None
    cell: str = "hex"


# The layers, their resolution and columns.
LAYERS = (
    Layer("emission_control_area", 7, ("id",)),
    Layer("management_plan_marine_areas", 7, ("area_id", "area_name_norwegian")),
    Layer("maritime_borders_norwegian_economic_zone", 9, ("id", "area_name")),
    Layer("maritime_borders_norwegian_continental_shelf", 9, ("id",)),
    Layer(
        "municipality",
        9,
        ("municipality_id as id", "municipality_name_no as name"),
        where=f"year = {config.MUNICIPALITY_YEAR}",
    ),
)
SHORE_POWER_CELL = "hex_kring_9_1"
SHORE_POWER_DISTANCE = "hex_kring_distance_9_1"


def read_layer(table: DataFrame, layer: Layer) -> DataFrame:
    """Filtered source columns with the layer name as prefix, plus the bare cell column."""
    source = table.filter(layer.where) if layer.where else table
    cell = f"{layer.cell}_{layer.resolution}"
    chosen = source.selectExpr(*layer.select, f"{cell} as _cell")
    renamed = {name: f"{layer.name}_{name}" for name in chosen.columns if name != "_cell"}
    return chosen.withColumnsRenamed(renamed).withColumnRenamed("_cell", cell)


def one_area_per_cell(layer_rows: DataFrame, layer: Layer) -> DataFrame:
    """The area with the lowest id (NULL first) of every cell, as a partial aggregate."""
    cell = f"{layer.cell}_{layer.resolution}"
    values = [name for name in layer_rows.columns if name != cell]
    lowest = layer_rows.groupBy(cell).agg(F.min(F.struct(*values)).alias("lowest"))
    return lowest.select(cell, *(F.col(f"lowest.{name}").alias(name) for name in values))


def cell_lookups(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All layers of one resolution merged into one lookup with one row per cell.

    Positions then need one join per resolution instead of one join and one
    window per layer.
    """
    lookups: dict[str, DataFrame] = {}
    for layer in LAYERS:
        if layer.name not in tables:
            continue
        cell = f"{layer.cell}_{layer.resolution}"
        rows = one_area_per_cell(read_layer(tables[layer.name], layer), layer)
        lookups[cell] = rows if cell not in lookups else lookups[cell].join(rows, cell, "full_outer")
    return lookups


def join_cells(points: DataFrame, lookups: dict[str, DataFrame]) -> DataFrame:
    """Add the area columns of every layer; positions outside an area get NULL."""
    for cell, lookup in lookups.items():
        points = points.join(small_side(lookup), cell, "left")
    return points


def nearest_shore_power(installations: DataFrame) -> DataFrame:
    """For every ring cell the nearest installation in use, as half-open year intervals.

    An installation counts from its year on, so the nearest one is a running
    minimum over the years. Each (cell, year) is reduced before the window, which
    therefore sees one row per year of a cell, however many installations it has.
    """
    candidate = F.struct(
        F.col(SHORE_POWER_DISTANCE).alias("distance"), F.col("bi_row_sha").alias("id"), "usage_percentage"
    )
    yearly = (
        installations.filter(F.col("year").isNotNull())
        .groupBy(SHORE_POWER_CELL, "year")
        .agg(F.min(candidate).alias("nearest"))
    )
    by_year = Window.partitionBy(SHORE_POWER_CELL).orderBy("year")
    running = by_year.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return yearly.select(
        F.col(SHORE_POWER_CELL).alias("_ring_cell"),
        F.col("year").alias("_from_year"),
        F.lead("year").over(by_year).alias("_until_year"),
        F.min("nearest").over(running).alias("_nearest"),
    ).select(
        "_ring_cell",
        "_from_year",
        "_until_year",
        F.col("_nearest.id").alias("shore_power_id"),
        F.col("_nearest.usage_percentage").alias("shore_power_usage_percentage"),
        F.col("_nearest.distance").alias(f"shore_power_{SHORE_POWER_DISTANCE}"),
    )


def join_shore_power(points: DataFrame, nearest: DataFrame) -> DataFrame:
    """Add the nearest installation (see `nearest_shore_power`) in use in the year of the position."""
    lookup = small_side(nearest)
    year = F.year(points["date_time_utc"])
    condition = (
        (points["hex_9"] == lookup["_ring_cell"])
        & (year >= lookup["_from_year"])
        & (lookup["_until_year"].isNull() | (year < lookup["_until_year"]))
    )
    return points.join(lookup, condition, "left").drop("_ring_cell", "_from_year", "_until_year")


def join_rings(points: DataFrame, layer_rows: DataFrame, name: str, resolution: int, rings: int) -> DataFrame:
    """Ring variant of a layer join without an as-of year: nearest ring cell, then lowest columns."""
    cell, distance = f"hex_kring_{resolution}_{rings}", f"hex_kring_distance_{resolution}_{rings}"
    values = [distance] + [c for c in layer_rows.columns if c not in (cell, distance)]
    nearest = layer_rows.groupBy(F.col(cell).alias(f"hex_{resolution}")).agg(
        F.min(F.struct(*values)).alias("nearest")
    )
    lookup = nearest.select(
        f"hex_{resolution}", *(F.col(f"nearest.{value}").alias(f"{name}_{value}") for value in values)
    )
    return points.join(small_side(lookup), f"hex_{resolution}", "left")


def with_parent_cells(points: DataFrame) -> DataFrame:
    return points.withColumns({f"hex_{r}": parent_cell(F.col("hex_14"), r) for r in (7, 9)})


def area_flags(points: DataFrame, close_cells: int = config.CLOSE_TO_POWER_CELLS) -> DataFrame:
    """Distance to shore power and flags for the areas a position lies in."""
    distance = F.coalesce(
        F.col(f"shore_power_{SHORE_POWER_DISTANCE}"), F.lit(config.NO_SHORE_POWER_DISTANCE)
    )
    return points.withColumns(
        {
            "dist_to_power": distance,
            "close_to_power": distance <= close_cells,
            "eca": F.col("emission_control_area_id").isNotNull(),
            "in_management_planning_area": F.col("management_plan_marine_areas_area_id").isNotNull(),
            "in_norwegian_continental_shelf": F.col(
                "maritime_borders_norwegian_continental_shelf_id"
            ).isNotNull(),
        }
    )
