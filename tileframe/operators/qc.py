"""Quality checks of finished estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.functions.keys import percent_diff, ratio, squash_name


def control_difference(
    estimates: DataFrame, control: DataFrame, adm1: str = "adm1", adm2: str = "adm2", households: str = "hh",
    name: str = "name", control_households: str = "households", absolute: bool = False,
) -> DataFrame:
    """Estimated and control households per province and their difference in percent.

    Tiles are added up to districts, districts to provinces.
    """
    districts = estimates.groupBy(adm1, adm2).agg(F.sum(households).alias("est_hh"))
    provinces = districts.groupBy(squash_name(F.col(adm1)).alias(adm1)).agg(F.sum("est_hh").alias("est_hh"))
    truth = control.select(squash_name(F.col(name)).alias(adm1), F.col(control_households).alias("control_hh"))
    diff = percent_diff(F.col("est_hh"), F.col("control_hh"))
    return provinces.join(truth, adm1).withColumn("pct_diff", F.abs(diff) if absolute else diff)


def area_per_household(
    estimates: DataFrame, floor_area: str = "floor_area", households: str = "hh",
    low: Sequence[float] = (50, 100), high: Sequence[float] = (400, 400),
) -> DataFrame:
    """Add floor area per household and whether it is out of the usual range.

    ``outlier`` uses the tighter limits (at most low[0], above high[0]); ``too_low`` and ``too_high``
    the wider ones (at most low[1], at least high[1]). Tiles without households have no ratio and no flag.
    """
    area = F.col("area_per_hh")
    return estimates.withColumn("area_per_hh", ratio(F.col(floor_area), F.col(households))).withColumns(
        {
            "outlier": (area <= low[0]) | (area > high[0]),
            "too_low": area <= low[1],
            "too_high": area >= high[1],
        }
    )


def floor_excess(
    buildings: DataFrame, estimates: DataFrame, tile: str = "tile", floors: str = "floors", households: str = "hh"
) -> DataFrame:
    """Tiles with more households than floors, and by how many percent: (tile, floors, hh, excess_pct)."""
    summed = buildings.groupBy(tile).agg(F.sum(floors).alias("total_floors"))
    joined = summed.join(estimates.select(tile, households), tile)
    excess = percent_diff(F.col(households), F.col("total_floors"))
    return joined.withColumn("excess_pct", excess).filter(F.col("excess_pct") > 0)


def worst_floor_excess(excess: DataFrame, rows: int = 300, tile: str = "tile") -> DataFrame:
    """The tiles with the largest excess; ties by tile."""
    return excess.orderBy(F.desc("excess_pct"), tile).limit(rows)


def worst_buildings(
    buildings: DataFrame, excess: DataFrame, rows: int = 300, tile: str = "tile", key: str = "building_id"
) -> DataFrame:
    """The buildings of the worst tiles, as many rows as asked; ties by tile and building."""
    found = buildings.join(excess.select(tile, "excess_pct"), tile)
    return found.orderBy(F.desc("excess_pct"), tile, key).limit(rows)


def more_households_than_buildings(estimates: DataFrame, buildings: str = "buildings", households: str = "hh") -> DataFrame:
    return estimates.filter(F.col(buildings) <= F.col(households))
