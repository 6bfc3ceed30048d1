"""Bounded random samples per group, the same on every run and every cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.functions.draws import normal_within_three, uniform

# Slots that one task generates at a time; larger groups are cut into several pieces.
CHUNK = 1 << 16


def ratio_bounds(
    df: DataFrame, mean: str = "pop_to_hh", spread: float = 3.0, sd: float = 0.29, lower: str = "lower", upper: str = "upper"
) -> DataFrame:
    """Add mean -/+ spread x sd, rounded to two decimals."""
    reach = F.lit(spread) * F.lit(sd)
    return df.withColumns(
        {upper: F.round(F.col(mean) + reach, 2), lower: F.round(F.col(mean) - reach, 2)}
    )


def sample_slots(groups: DataFrame, count: str) -> DataFrame:
    """One row per (group, slot 1..count). A large group becomes many pieces on many tasks.

    The pieces are tiny rows, which adaptive execution would merge into one task, so the number of tasks
    is given; it follows from the number of slots, one aggregate over the groups."""
    n = F.col(count)
    pieces = groups.filter(n > 0).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / F.lit(CHUNK)))).alias("_piece")
    )
    first = F.col("_piece") * CHUNK + 1
    last = F.least(first + CHUNK - 1, n.cast("long"))
    slots = groups.filter(n > 0).agg(F.sum(n.cast("long"))).first()[0] or 0
    return (
        pieces.repartition(max(1, -(-slots // CHUNK)), "_piece", *groups.columns)
        .select("*", F.explode(F.sequence(first, last)).alias("slot"))
        .drop("_piece")
    )


def gaussian_samples(
    groups: DataFrame, group: str, count: str = "n", lower: str = "lower", upper: str = "upper", value: str = "sample"
) -> DataFrame:
    """``count`` normal draws per group within [lower, upper]: (group, slot, value).

    The mean is the middle of the bounds and the bounds lie three deviations away. Draws come from the inverse of the
    normal distribution cut off there, so each slot takes one draw and none is rejected. The seed of a draw is its
    group and slot.
    """
    middle = (F.col(lower) + F.col(upper)) / 2
    deviation = (F.col(upper) - F.col(lower)) / 6
    seed = F.concat_ws(":", F.col(group), F.col("slot").cast("string"))
    draw = F.greatest(F.col(lower), F.least(F.col(upper), middle + deviation * normal_within_three(seed)))
    return sample_slots(groups.select(group, count, lower, upper), count).select(group, "slot", draw.alias(value))


def uniform_samples(
    groups: DataFrame, group: str, count: str = "n", lower: str = "lower", upper: str = "upper",
    value: str = "sample", seed: int = 42,
) -> DataFrame:
    """``count`` uniform draws per group within [lower, upper]: (group, slot, value)."""
    key = F.concat_ws(":", F.lit(str(seed)), F.col(group), F.col("slot").cast("string"))
    draw = F.col(lower) + (F.col(upper) - F.col(lower)) * uniform(key)
    return sample_slots(groups.select(group, count, lower, upper), count).select(group, "slot", draw.alias(value))
