"""The household grid from tile populations: scale, sample, match, estimate, correct; and by truth sets of districts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.functions.keys import squash_name
from tileframe.operators.households import (
    combine_sources, control_ratio, household_correction, household_estimate, route_districts, scale_to_control,
)
from tileframe.operators.qc import control_difference
from tileframe.operators.rank import rank_match
from tileframe.operators.sampling import gaussian_samples, ratio_bounds, uniform_samples
from tileframe.sources.workspace import stored


def province_samples(tiles: DataFrame, control: DataFrame, spread: float = 3.0, kind: str = "gaussian", seed: int = 42) -> DataFrame:
    """One persons-per-household draw for every tile of each province: (adm1, slot, sample).

    ``tiles`` has one row per tile with its normalised ``adm1``; ``control`` has ``name`` and ``pop_to_hh``.
    """
    counts = tiles.groupBy("adm1").agg(F.count(F.lit(1)).alias("n"))
    means = control.select(squash_name(F.col("name")).alias("adm1"), F.round("pop_to_hh", 2).alias("pop_to_hh"))
    groups = ratio_bounds(means, "pop_to_hh", spread).join(counts, "adm1")
    if kind == "uniform":
        return uniform_samples(groups, "adm1", seed=seed)
    return gaussian_samples(groups, "adm1")


def estimate_households(
    populations: DataFrame, tile_map: DataFrame, tile_metric: DataFrame, control: DataFrame, spread: float = 3.0,
    kind: str = "gaussian", rounded: bool = True,
) -> DataFrame:
    """Households per tile.

    Populations (tile, pop) are scaled to the control population of their province; the tile with
    the largest floor area then gets the smallest persons-per-household draw, and so on.
    Returns (tile, adm1, ratio, pop, adjusted_pop, floor_area, pop_to_hh, hh).
    """
    placed = populations.join(tile_map.select("tile", "adm1"), "tile")
    ratios = control_ratio(placed, control)
    scaled = scale_to_control(populations, tile_map, ratios)
    # Read three times from here on: counts, range bounds, ranks.
    measured = stored(scaled.join(tile_metric.select("tile", "floor_area"), "tile"), "measured")
    samples = province_samples(measured, control, spread, kind)
    matched = rank_match(measured, samples, "adm1", "floor_area", ["tile"]).withColumnRenamed("sample", "pop_to_hh")
    return matched.withColumn("hh", household_estimate(F.col("adjusted_pop"), F.col("pop_to_hh"), rounded))


def district_job(
    tiles: DataFrame, truth: DataFrame, buildings: DataFrame, *others: DataFrame, limit: float = 2.0,
    overrides: DataFrame | None = None, denominator: str = "buildings",
) -> DataFrame:
    """The final grid of whole households: (tile, adm1, adm2, adm3, hh, method).

    Tiles with a truth set for their district are brought to it, by multiplier or by buildings; the grids of
    ``others`` (tile, names, hh) are added as ``other``, names are made alike, duplicates added up, and overrides put in.
    ``method`` lists where the households of a tile come from.
    """
    routed = route_districts(tiles, truth, buildings, limit, denominator=denominator)
    parts = [routed.select("tile", "adm1", "adm2", "adm3", "hh", "method")]
    parts += [o.select("tile", "adm1", "adm2", "adm3", "hh", F.lit("other").alias("method")) for o in others]
    return combine_sources(*parts, overrides=overrides, origin="method")


def corrected_households(estimates: DataFrame, control: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Estimates corrected to the control counts, and the check of the corrected ones: (adm1, est_hh, control_hh, pct_diff).

    What is left of the difference is the rounding of each tile."""
    corrected = stored(household_correction(estimates, control), "corrected")
    again = corrected.drop("hh").withColumnRenamed("hh_corrected", "hh")
    return corrected, control_difference(again, control)
