"""Similar-size neighbours: band join, band averages, and the imputation cascade."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.operators.ordered import running_sums
from tileframe.sources.workspace import broadcast_if_small, stored

#: Donors of a block of the band join, and targets of a portion that meets it.
BLOCK = 1024
_DIGITS = 38


def _exact_type(donors: DataFrame, measure: str) -> str:
    """Decimals for sums, so that differences of running totals lose no digits. One aggregate finds how many
    digits the largest possible total needs; all others are decimal places. Raises where a total does not fit."""
    size = F.abs(F.col(measure).cast("double"))
    row = donors.agg(F.max(size).alias("top"), F.count(size).alias("n")).first()
    if not row["top"]:
        return f"decimal({_DIGITS},10)"
    if not math.isfinite(row["top"]):
        raise ValueError(f"{measure} holds numbers that are not finite")
    whole = max(1, math.floor(math.log10(row["top"]) + math.log10(row["n"])) + 3)
    if whole > _DIGITS:
        raise ValueError(f"totals of {measure} need more than {_DIGITS} digits")
    return f"decimal({_DIGITS},{_DIGITS - whole})"


def band_join(
    targets: DataFrame,
    donors: DataFrame,
    groups: Sequence[str],
    value: str,
    measure: str,
    low: float = 0.8,
    high: float = 1.2,
) -> DataFrame:
    """Left join of each target to the donors of its group whose value is in [low, high] x its own.

    Returns the target columns, ``neighbour_<value>`` and ``neighbour_<measure>``; a target without
    neighbours keeps one row with NULLs, also where its value or a name of its group is NULL. Repeated rows are
    targets, or donors, of their own. The result holds every matching pair; where only averages are wanted use
    ``band_averages``, which forms none.

    Donors are numbered in one order of (group, value), and the two ends of each target's band are placed in the same
    order: the neighbours of a target are then the donors of one stretch of numbers. The order is cut into blocks of
    ``BLOCK`` donors, and a target is offered to the blocks that its stretch meets. A block that many targets meet
    is dealt out in portions of ``BLOCK`` targets, each with its own copy of the block's donors. So a task reads bounded
    blocks, whatever share of the rows one group or one value has, and the rows that are moved are in proportion to
    the rows of the two tables and the pairs of the result.
    """
    blocks = band_blocks(targets, donors, groups, value, measure, low, high)
    on = (F.col("_block") == F.col("_d_block")) & (F.col("_portion") == F.col("_d_portion"))
    on = on & (F.col("_at") >= F.col("_from")) & (F.col("_at") <= F.col("_to"))
    found = [f"neighbour_{value}", f"neighbour_{measure}"]
    pairs = blocks.targets.join(blocks.donors, on).select(*[F.col(f"_t.{c}").alias(c) for c in targets.columns], *found)
    alone = blocks.alone.select(
        *[F.col(f"_t.{c}").alias(c) for c in targets.columns],
        F.lit(None).cast(donors.schema[value].dataType).alias(found[0]),
        F.lit(None).cast(donors.schema[measure].dataType).alias(found[1]),
    )
    return pairs.unionByName(alone)


@dataclass(frozen=True)
class Blocks:
    """Targets and donors of a band join, by block and portion, and the targets that meet no donor."""

    targets: DataFrame
    donors: DataFrame
    alone: DataFrame


def band_blocks(
    targets: DataFrame, donors: DataFrame, groups: Sequence[str], value: str, measure: str, low: float = 0.8, high: float = 1.2
) -> Blocks:
    """The two sides of ``band_join``: ``_t, _id, _from, _to, _block, _portion`` and ``_at, _d_block, _d_portion`` with the donor's values."""
    names = [F.col(g).cast("string") for g in groups]
    # Length-prefixed, so that different lists of names never look alike; NULL if any name is.
    group = F.concat(F.lit(""), *[part for n in names for part in (F.length(n).cast("string"), F.lit(":"), n)])
    v = F.col(value).cast("double")
    whole = F.struct(*[F.col(f"`{c}`") for c in targets.columns])
    own = stored(targets.select(F.monotonically_increasing_id().alias("_id"), whole.alias("_t"), group.alias("_grp"), v.alias("_v")), "targets")
    placed = own.filter("_grp IS NOT NULL AND _v IS NOT NULL")
    none_t = F.lit(None).cast(own.schema["_t"].dataType).alias("_t")
    values = [F.col(value).alias(f"neighbour_{value}"), F.col(measure).alias(f"neighbour_{measure}")]
    given = donors.select(
        group.alias("_grp"), v.alias("_v"), F.lit(1).alias("_kind"), F.xxhash64(*[F.col(f"`{c}`") for c in donors.columns]).alias("_id"),
        F.lit(1).cast("long").alias("_one"), none_t, *values,
    ).filter("_grp IS NOT NULL AND _v IS NOT NULL")
    no_values = [F.lit(None).cast(given.schema[c].dataType).alias(c) for c in given.columns[-2:]]
    zero = F.lit(0).cast("long").alias("_one")
    # The lower end sorts before donors of the same value, the upper end after them.
    lower = placed.select("_grp", (F.col("_v") * F.lit(low)).alias("_v"), F.lit(0).alias("_kind"), "_id", zero, "_t", *no_values)
    upper = placed.select("_grp", (F.col("_v") * F.lit(high)).alias("_v"), F.lit(2).alias("_kind"), "_id", zero, none_t, *no_values)
    line = running_sums(given.unionByName(lower).unionByName(upper), [], ["_grp", "_v", "_kind", "_id"], {"_at": "_one"})
    line = stored(line.select("_kind", "_id", "_t", *given.columns[-2:], "_at"), "line")
    ends = line.filter("_kind <> 1").groupBy("_id").agg(
        F.any_value("_t", ignoreNulls=True).alias("_t"),
        (F.max(F.when(F.col("_kind") == 0, F.col("_at"))) + 1).alias("_from"),
        F.max(F.when(F.col("_kind") == 2, F.col("_at"))).alias("_to"),
    )
    ends = stored(ends, "ends")

    def block(at: Column) -> Column:
        return F.floor((at - 1) / F.lit(BLOCK)).cast("long")

    met = ends.filter("_from <= _to")
    offered = met.select("*", F.explode(F.sequence(block(F.col("_from")), block(F.col("_to")))).alias("_block"))
    # At most one row for every BLOCK donors.
    load = stored(offered.groupBy("_block").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("_portions")), "load")
    small = broadcast_if_small(load)
    portion = F.pmod(F.xxhash64("_id"), F.col("_portions")).cast("int").alias("_portion")
    left = offered.join(small, "_block").select("_t", "_id", "_from", "_to", "_block", portion)
    right = line.filter("_kind = 1").select(block(F.col("_at")).alias("_block"), "_at", *given.columns[-2:]).join(small, "_block")
    right = right.select(
        F.col("_block").alias("_d_block"), "_at", *given.columns[-2:],
        F.explode(F.sequence(F.lit(0), F.col("_portions") - 1)).alias("_d_portion"),
    )
    alone = ends.filter("_from > _to").select("_t").unionByName(own.filter("_grp IS NULL OR _v IS NULL").select("_t"))
    return Blocks(left, right, alone)


def band_averages(
    targets: DataFrame,
    donors: DataFrame,
    levels: Sequence[Sequence[str]],
    value: str,
    measure: str,
    low: float = 0.8,
    high: float = 1.2,
) -> DataFrame:
    """Average measure of the donors in each target's band, at each level of grouping.

    Adds ``_avg_0``, ``_avg_1``, ... to the targets, NULL where a band is empty.

    No pairs are formed: per group, donors and the two ends of each band are put in one order,
    and a band's sum and count are the running totals at its upper end minus those at its lower
    end. The cost is one sort of (donors + 2 x targets) rows per level, however many donors a
    band holds and however many rows share a group.
    """

    def group_at(i: int) -> Column:
        """Names of a level as one text, length-prefixed so that different lists never look alike;
        NULL if any name is."""
        names = [F.col(g).cast("string") for g in levels[i]]
        return F.concat(*[part for n in names for part in (F.length(n).cast("string"), F.lit(":"), n)])

    def at_levels(df: DataFrame, ends: Sequence[tuple[Column, int]], *columns: Column) -> DataFrame:
        """One row per level and end: (_lvl, _grp, _v, _kind, columns)."""
        rows = [
            F.struct(
                F.lit(i).alias("_lvl"), group_at(i).alias("_grp"), v.cast("double").alias("_v"), F.lit(kind).alias("_kind")
            )
            for i in range(len(levels))
            for v, kind in ends
        ]
        spread = df.filter(F.col(value).isNotNull()).select(F.explode(F.array(*rows)).alias("_row"), *columns)
        kept = [c for c in spread.columns if c != "_row"]
        return spread.select("_row.*", *kept).filter("_grp IS NOT NULL")

    v = F.col(value)
    exact = _exact_type(donors, measure)
    own = [F.col(c).alias(f"_t_{c}") for c in targets.columns]
    none = [F.lit(None).cast(targets.schema[c].dataType).alias(f"_t_{c}") for c in targets.columns]
    # Donors of equal value are one row before anything is sorted.
    given = (
        at_levels(donors, [(v, 1)], F.col(measure).cast(exact).alias("_m"))
        .groupBy("_lvl", "_grp", "_v", "_kind")
        .agg(F.sum("_m").cast(exact).alias("_m"), F.count("_m").alias("_c"))
        .select("_lvl", "_grp", "_v", "_kind", "_m", "_c", *none)
    )
    # The lower end sorts before donors of the same value, the upper end after them.
    asked = at_levels(
        targets, [(v * F.lit(low), 0), (v * F.lit(high), 2)],
        F.lit(0).cast(exact).alias("_m"), F.lit(0).cast("long").alias("_c"), *own,
    )
    stacked = given.unionByName(asked)

    order = ["_v", "_kind", *[f"_t_{c}" for c in targets.columns]]
    totals = running_sums(stacked, ["_lvl", "_grp"], order, {"_ms": "_m", "_cs": "_c"}).filter("_kind <> 1")

    def signed(name: str) -> Column:
        return F.when(F.col("_kind") == 2, F.col(name)).otherwise(-F.col(name))

    folds = []
    for i in range(len(levels)):
        here = F.col("_lvl") == i
        folds.append(F.sum(F.when(here, signed("_ms"))).cast("double").alias(f"_s_{i}"))
        folds.append(F.sum(F.when(here, signed("_cs"))).alias(f"_n_{i}"))
    # No level applies to targets whose value or whose names are all missing: their averages are NULL.
    bands = totals.groupBy(*[F.col(f"_t_{c}").alias(c) for c in targets.columns]).agg(*folds)
    averages = [
        F.when(F.col(f"_n_{i}") > 0, F.try_divide(F.col(f"_s_{i}"), F.col(f"_n_{i}"))).alias(f"_avg_{i}")
        for i in range(len(levels))
    ]
    return bands.select(*targets.columns, *averages)


def impute_cascade(
    tiles: DataFrame,
    levels: Sequence[Sequence[str]] = (("adm1", "adm2", "adm3"), ("adm1", "adm2"), ("adm1",)),
    tile: str = "tile",
    value: str = "floor_area",
    measure: str = "pop",
    low: float = 0.8,
    high: float = 1.2,
    stage: str | None = None,
) -> DataFrame:
    """Fill missing measures with the average of similar tiles nearby.

    Similar means a value within [low, high] times that of the tile; nearby means the same names
    at the first level that has any similar tile. Tiles without one at any level are dropped
    (``unresolved_tiles`` returns them). ``stage`` names a column to tell where a measure comes
    from: 0 observed, 1 first level, and so on.
    """
    names = sorted({c for level in levels for c in level}, reverse=True)
    # Read many times below, and twice more for the bounds of the sort.
    tiles = stored(tiles.select(tile, value, *names, measure), "tiles")
    known = tiles.filter(F.col(measure).isNotNull())
    targets = tiles.filter(F.col(measure).isNull()).select(tile, value, *names)
    bands = band_averages(targets, known.select(value, measure, *names), levels, value, measure, low, high)
    choices = [F.col(f"_avg_{i}") for i in range(len(levels))]
    filled = bands.select(tile, value, *names, F.coalesce(*choices).alias(measure), *choices).filter(
        F.col(measure).isNotNull()
    )
    outputs = [tile, value, *names, measure]
    if stage is None:
        return known.select(*outputs).unionByName(filled.select(*outputs))
    which = F.coalesce(*[F.when(c.isNotNull(), i + 1) for i, c in enumerate(choices)])
    return known.select(*outputs, F.lit(0).alias(stage)).unionByName(
        filled.select(*outputs, which.alias(stage))
    )


def unresolved_tiles(tiles: DataFrame, imputed: DataFrame, tile: str = "tile") -> DataFrame:
    """Tiles that the cascade could not fill."""
    return tiles.join(imputed.select(tile), tile, "left_anti")
