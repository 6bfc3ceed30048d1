"""From tile populations to household counts that agree with control totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.functions.keys import ratio, snake_name, squash_name
from tileframe.operators.tables import override_values, salted_join, union_all, with_group_totals
from tileframe.sources.workspace import is_small, stored

DISTRICT = ("adm1", "adm2")


def tile_population(points: DataFrame, tile: str = "tile", pop: str = "pop") -> DataFrame:
    """Sum of the points of each tile."""
    return points.groupBy(tile).agg(F.sum(pop).alias(pop))


def control_ratio(
    tiles: DataFrame, control: DataFrame, adm1: str = "adm1", pop: str = "pop",
    name: str = "name", control_pop: str = "population",
) -> DataFrame:
    """Control population over tile population, per normalised province: (adm1, ratio)."""
    summed = tiles.groupBy(squash_name(F.col(adm1)).alias(adm1)).agg(F.sum(pop).alias("_pop"))
    truth = control.select(squash_name(F.col(name)).alias(adm1), F.col(control_pop).alias("_control"))
    rated = summed.join(truth, adm1).select(adm1, ratio(F.col("_control"), F.col("_pop")).alias("ratio"))
    return _bounded_by(rated, truth)


def scale_to_control(
    populations: DataFrame, tile_map: DataFrame, ratios: DataFrame, tile: str = "tile",
    adm1: str = "adm1", pop: str = "pop", scaled: str = "adjusted_pop",
) -> DataFrame:
    """Multiply each tile's population by the ratio of its province: (tile, adm1, ratio, pop, scaled)."""
    mapped = tile_map.select(tile, squash_name(F.col(adm1)).alias(adm1))
    rated = mapped.join(ratios, adm1)
    return rated.join(populations.select(tile, pop), tile).select(
        tile, adm1, "ratio", pop, (F.col("ratio") * F.col(pop)).alias(scaled)
    )


def household_estimate(pop: Column, per_household: Column, rounded: bool = True) -> Column:
    """Households of a tile: population over persons per household; NULL for a zero divisor."""
    value = ratio(pop, per_household)
    return F.round(value, 0) if rounded else value


def household_correction(
    estimates: DataFrame, control: DataFrame, adm1: str = "adm1", households: str = "hh",
    pop: str = "adjusted_pop", name: str = "name", control_households: str = "households",
) -> DataFrame:
    """Scale households so that provinces meet their control count.

    Adds the province estimate, the control count, the corrected households (whole numbers) and the
    persons per household that follow from them (NULL where no household is left).
    """
    truth = control.select(squash_name(F.col(name)).alias(adm1), F.col(control_households).alias("control_hh"))
    province = estimates.groupBy(adm1).agg(F.sum(households).alias("province_hh")).join(truth, adm1)
    corrected = F.round(ratio(F.col(households) * F.col("control_hh"), F.col("province_hh")), 0)
    return (
        estimates.join(_bounded_by(province, truth), adm1)
        .withColumn("hh_corrected", corrected)
        .withColumn("pop_to_hh_corrected", ratio(F.col(pop), F.col("hh_corrected")))
    )


def _bounded_by(df: DataFrame, bound: DataFrame) -> DataFrame:
    """Broadcast a join result that has at most one row per row of ``bound``, if that table is small."""
    return F.broadcast(df) if is_small(bound) else df


def district_multipliers(
    tiles: DataFrame, truth: DataFrame, keys: Sequence[str] = DISTRICT, pop: str = "adjusted_pop",
    truth_pop: str = "population",
) -> DataFrame:
    """Truth population over estimated population per district: (keys, estimated, truth, multiplier)."""
    summed = tiles.groupBy(*keys).agg(F.sum(pop).alias("estimated_pop"))
    known = truth.select(*keys, F.col(truth_pop).alias("truth_pop"))
    joined = summed.join(known, list(keys))
    return _bounded_by(
        joined.withColumn("multiplier", ratio(F.col("truth_pop"), F.col("estimated_pop"))), known
    )


def split_extremes(multipliers: DataFrame, limit: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Districts with a multiplier of at most ``limit`` (or none), and those above it."""
    above = F.col("multiplier") > limit
    return multipliers.filter(~F.coalesce(above, F.lit(False))), multipliers.filter(above)


def apply_multipliers(
    tiles: DataFrame, multipliers: DataFrame, keys: Sequence[str] = DISTRICT,
    pop: str = "adjusted_pop", per_household: str = "pop_to_hh",
) -> DataFrame:
    """Scale tiles by their district's multiplier and divide by persons per household."""
    scaled = tiles.join(multipliers.select(*keys, "multiplier"), list(keys))
    scaled = scaled.withColumn("truth_adjusted_pop", F.col("multiplier") * F.col(pop))
    return scaled.withColumn("hh", ratio(F.col("truth_adjusted_pop"), F.col(per_household)))


def reallocate_by_buildings(
    tiles: DataFrame, districts: DataFrame, buildings: DataFrame, keys: Sequence[str] = DISTRICT,
    tile: str = "tile", per_household: str = "pop_to_hh", denominator: str = "buildings",
) -> DataFrame:
    """Spread each district's truth population over its tiles by their share of the buildings.

    ``denominator`` is what a tile's building count is divided by: ``buildings`` (all buildings in
    the district's tiles, which preserves the district total) or ``rows`` (the number of those
    tiles). Tiles without buildings get no row.
    """
    if denominator not in ("buildings", "rows"):
        raise ValueError("denominator must be 'buildings' or 'rows'")
    wanted = tiles.join(districts.select(*keys, "truth_pop"), list(keys))
    per_tile = buildings.groupBy(tile).agg(F.count(F.lit(1)).alias("tile_buildings"))
    counted = wanted.join(per_tile, tile)
    total = F.sum("tile_buildings") if denominator == "buildings" else F.count(F.lit(1))
    shared = with_group_totals(counted, keys, [total.alias("district_total")])
    shared = shared.withColumn(
        "truth_adjusted_pop", ratio(F.col("truth_pop") * F.col("tile_buildings"), F.col("district_total"))
    )
    return shared.withColumn("hh", ratio(F.col("truth_adjusted_pop"), F.col(per_household)))


def route_districts(
    tiles: DataFrame, truth: DataFrame, buildings: DataFrame, limit: float = 2.0, keys: Sequence[str] = DISTRICT,
    tile: str = "tile", pop: str = "adjusted_pop", per_household: str = "pop_to_hh", truth_pop: str = "population",
    denominator: str = "buildings",
) -> DataFrame:
    """Bring every tile to the truth population of its district, by the way that suits the district.

    Districts whose multiplier (truth over estimate) is at most ``limit`` scale their tiles by it; in the others the
    estimate says too little, and the truth population is spread by the tiles' share of the buildings, as in
    ``reallocate_by_buildings``. One pass: the tiles get their number of buildings, one aggregate gives
    each district its estimate, its buildings and so its way, and one join takes that back to the tiles, where a district
    with most of the tiles is dealt to many tasks.

    Adds ``multiplier``, ``method`` (``multiplier`` or ``buildings``), ``truth_adjusted_pop`` and ``hh``. Districts without a
    truth population, without a multiplier (an estimate of zero), and tiles without buildings in a district that is spread
    get no row, as in the two operators alone.
    """
    if denominator not in ("buildings", "rows"):
        raise ValueError("denominator must be 'buildings' or 'rows'")
    per_tile = buildings.groupBy(tile).agg(F.count(F.lit(1)).alias("_buildings"))
    counted = stored(tiles.join(per_tile, tile, "left"), "counted")
    total = F.sum("_buildings") if denominator == "buildings" else F.count("_buildings")
    facts = counted.groupBy(*keys).agg(
        F.sum(pop).alias("_estimated"), total.alias("_total"), F.count(F.lit(1)).alias("_rows")
    )
    known = truth.select(*keys, F.col(truth_pop).alias("_truth"))
    facts = facts.join(known, list(keys)).withColumn("multiplier", ratio(F.col("_truth"), F.col("_estimated")))
    facts = facts.filter(F.col("multiplier").isNotNull())
    facts = facts.withColumn("method", F.when(F.col("multiplier") > limit, "buildings").otherwise("multiplier"))
    routed = salted_join(counted, stored(facts.drop("_estimated"), "districts"), keys, "_rows")
    by_buildings = F.col("method") == "buildings"
    spread = ratio(F.col("_truth") * F.col("_buildings"), F.col("_total"))
    scaled = routed.filter(~by_buildings | F.col("_buildings").isNotNull()).withColumn(
        "truth_adjusted_pop", F.when(by_buildings, spread).otherwise(F.col("multiplier") * F.col(pop))
    )
    out = scaled.withColumn("hh", ratio(F.col("truth_adjusted_pop"), F.col(per_household)))
    return out.drop("_buildings", "_total", "_truth")


def combine_sources(
    *sources: DataFrame, overrides: DataFrame | None = None, tile: str = "tile",
    names: Sequence[str] = ("adm1", "adm2", "adm3"), households: str = "hh", origin: str | None = None,
) -> DataFrame:
    """One household grid from several producers, with the columns (tile, names, households).

    Names are put in snake case, duplicates are added up, overrides replace the value of their
    tile, and what is above zero is rounded up to whole households. ``origin`` names a column of
    all sources that says where a row comes from; the result then lists the origins of each tile, sorted.
    """
    more = [origin] if origin else []
    parts = [s.select(tile, *names, F.col(households).cast("double").alias(households), *more) for s in sources]
    clean = union_all(*parts).withColumns({n: snake_name(F.col(n)) for n in names})
    listed = [F.array_join(F.sort_array(F.collect_set(c)), ",").alias(c) for c in more]
    summed = clean.groupBy(tile, *names).agg(F.sum(households).alias(households), *listed)
    if overrides is not None:
        summed = override_values(summed, overrides, tile, households)
    return summed.filter(F.col(households) > 0).withColumn(households, F.ceil(households).cast("int"))


def district_totals(
    estimates: DataFrame, tile_map: DataFrame, keys: Sequence[str] = DISTRICT, tile: str = "tile",
    pop: str = "adjusted_pop", households: str = "hh",
) -> DataFrame:
    """Population and households per district."""
    mapped = estimates.select(tile, pop, households).join(tile_map.select(tile, *keys), tile)
    return mapped.groupBy(*keys).agg(F.sum(pop).alias(pop), F.sum(households).alias(households))


def built_up_share(floor_area: Column, tile_area: float = 360000.0, percent: bool = False) -> Column:
    """Floor area over tile area."""
    return floor_area * (100.0 if percent else 1.0) / F.lit(tile_area)
