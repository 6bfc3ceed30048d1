"""Cell features of pings and places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.functions.cells import geohash, parent_cell, tile_key
from tileframe.operators.ordered import row_numbers
from tileframe.sources.workspace import broadcast_if_small

NULL_CATEGORY = "null"


def ping_cells(pings: DataFrame, lat: str = "lat", lon: str = "lon", zoom: int = 16) -> DataFrame:
    """Add ``gh6``, its parent ``gh5`` and ``tile``; coordinates may be text."""
    cast = pings.withColumns({lat: F.col(lat).try_cast("double"), lon: F.col(lon).try_cast("double")})
    keyed = cast.withColumns(
        {"gh6": geohash(F.col(lat), F.col(lon), 6), "tile": tile_key(F.col(lat), F.col(lon), zoom)}
    )
    return keyed.withColumn("gh5", parent_cell(F.col("gh6"), 5))


def category_values(df: DataFrame, category: str, most: int = 10_000) -> list[str]:
    """The category list of a table, sorted; raises if it is too long to become columns."""
    named = F.coalesce(F.col(category), F.lit(NULL_CATEGORY)).alias("c")
    rows = df.select(named).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} categories")
    return sorted(r["c"] for r in rows)


def category_rows(df: DataFrame, cell: str, category: str) -> DataFrame:
    """The counts in long form, for any number of categories: one row per cell and category with ``rows``."""
    named = F.coalesce(F.col(category), F.lit(NULL_CATEGORY)).alias(category)
    return df.groupBy(cell, named).agg(F.count(F.lit(1)).alias("rows"))


def category_dictionary(df: DataFrame, category: str, index: str = "index") -> DataFrame:
    """The categories in order with their number from 0, for any number of them; missing ones count as ``null``."""
    named = df.select(F.coalesce(F.col(category), F.lit(NULL_CATEGORY)).alias(category)).distinct()
    return row_numbers(named, [], [category], index).withColumn(index, F.col(index) - 1)


def category_matrix(
    df: DataFrame, cells: Sequence[Column], category: str, dictionary: DataFrame, cell: str = "cell", index: str = "index"
) -> DataFrame:
    """One sparse row per cell: (cell, indices, counts), where ``indices`` are the categories of the cell in order.

    ``cells`` are the keys of a row, such as its cells at several resolutions: it counts once in each. Rows are counted by cell and
    category before anything else moves, so a cell or a category with most of the rows is one line per task. What comes together
    in one row are the different categories of a cell, never its rows.
    """
    named = F.coalesce(F.col(category), F.lit(NULL_CATEGORY)).alias(category)
    keyed = df.select(named, F.explode(F.array(*cells)).alias(cell))
    counted = keyed.groupBy(cell, category).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.join(broadcast_if_small(dictionary), category)
    listed = F.sort_array(F.collect_list(F.struct(F.col(index), F.col("_n"))))
    packed = numbered.groupBy(cell).agg(listed.alias("_l"))
    return packed.select(
        cell, F.transform("_l", lambda e: e[index]).alias("indices"), F.transform("_l", lambda e: e["_n"]).alias("counts")
    )


def category_counts(
    df: DataFrame, cell: str, category: str, values: Sequence[str] | None = None
) -> DataFrame:
    """One row per cell, one column per category with the number of rows, 0 where there is none.

    Without ``values`` the categories are looked up once; give them to keep several tables alike. Where
    there are too many for columns, use ``category_matrix`` or ``category_rows``.
    """
    values = category_values(df, category) if values is None else list(values)
    named = df.select(cell, F.coalesce(F.col(category), F.lit(NULL_CATEGORY)).alias("_category"))
    return named.groupBy(cell).pivot("_category", values).agg(F.count(F.lit(1))).fillna(0)


def roll_up_cells(counts: DataFrame, cell: str, length: int, parent: str) -> DataFrame:
    """Sums of all count columns per parent cell (a shorter prefix of the key)."""
    sums = [F.sum(F.col(f"`{c}`")).alias(c) for c in counts.columns if c != cell]
    return counts.groupBy(parent_cell(F.col(cell), length).alias(parent)).agg(*sums)


def attach_labels(
    places: DataFrame, catalog: DataFrame, key: str = "place_id", lat: str = "lat",
    labels: str = "labels", text: str | None = None,
) -> DataFrame:
    """Located places with the label list of their catalog row; ``text`` adds the list as one string."""
    joined = places.filter(F.col(lat).isNotNull()).join(catalog.select(key, labels), key)
    return joined.withColumn(text, F.array_join(labels, ", ")) if text else joined


def pings_of_providers(pings: DataFrame, providers: Sequence[str], isp: str = "isp") -> DataFrame:
    """Distinct pings of the named internet providers."""
    return pings.filter(F.col(isp).isNotNull() & F.col(isp).isin(*providers)).distinct()


def building_profile(
    buildings: DataFrame, tile: str = "tile", floors: str = "floors", residential: str | None = "residential"
) -> DataFrame:
    """Per tile: buildings, floors, mean floors, and residential buildings (sum and count of the flag)."""
    folds: list[Column] = [
        F.count(F.lit(1)).alias("buildings"),
        F.sum(floors).alias("floors"),
        F.avg(floors).alias("floors_per_building"),
    ]
    if residential:
        folds += [
            F.sum(residential).alias("residential"),
            F.count(residential).alias("classified"),
        ]
    return buildings.groupBy(tile).agg(*folds)
