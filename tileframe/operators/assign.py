"""Tiles to administrative areas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.functions.cells import tile_bounds, tile_centroid
from tileframe.operators.cover import Cover, cover_polygons
from tileframe.operators.spatial_join import join_boxes, join_points, largest_side
from tileframe.sources.workspace import stored


def cover_areas(
    tiles: DataFrame, areas: DataFrame, columns: Sequence[str], tile: str = "tile", **options
) -> Cover:
    """Cover of the areas with cells no smaller than the tiles, to use in several of the steps below."""
    side = largest_side(tiles, tile_bounds(F.col(tile)))
    return cover_polygons(areas, columns, coarsest=side, **options)


def tiles_by_centroid(
    tiles: DataFrame, areas: DataFrame | Cover, columns: Sequence[str], tile: str = "tile", **options
) -> DataFrame:
    """Areas that hold a tile's centroid strictly inside: (tile, area columns)."""
    middle = tile_centroid(F.col(tile))
    centroids = tiles.select(tile, middle["lon"].alias("_lon"), middle["lat"].alias("_lat"))
    hits = join_points(centroids, areas, columns, predicate="contains", x="_lon", y="_lat", **options)
    return hits.select(tile, *columns)


def tile_overlaps(
    tiles: DataFrame, areas: DataFrame | Cover, columns: Sequence[str], tile: str = "tile",
    area: str | None = None, **options
) -> DataFrame:
    """Every area a tile meets, touching included, and optionally the overlap in squared degrees."""
    return join_boxes(tiles, [tile], tile_bounds(F.col(tile)), areas, columns, area=area, **options)


def assign_tiles(
    tiles: DataFrame, areas: DataFrame, columns: Sequence[str], tile: str = "tile", **options
) -> DataFrame:
    """Give each tile its area: by centroid, else the area with the largest overlap.

    A tile that meets only one area gets that one, even if they just touch. Equal overlaps
    go to the area that comes first by its columns. Tiles that meet no area are left out.
    """
    # Stored, as both are used again: the tiles in each step, the hits in the result and to find
    # what is left. It also keeps tests of a tile's position behind the removal of duplicates.
    distinct = stored(tiles.select(tile).distinct(), "tiles")
    cover = cover_areas(distinct, areas, columns, tile, **options)
    direct = stored(tiles_by_centroid(distinct, cover, columns, tile), "tiles")
    rest = distinct.join(direct.select(tile), tile, "left_anti")
    overlaps = tile_overlaps(rest, cover, columns, tile, area="_area")
    # min_by of (-overlap, columns): one aggregate with map-side combine, no per-tile sort.
    best = overlaps.groupBy(tile).agg(
        F.min_by(F.struct(*columns), F.struct(-F.col("_area"), *columns)).alias("_best")
    )
    return direct.unionByName(best.select(tile, *[F.col(f"_best.{c}").alias(c) for c in columns]))


def unassigned_tiles(
    tiles: DataFrame, areas: DataFrame, columns: Sequence[str], tile: str = "tile", **options
) -> DataFrame:
    """Tiles that no area meets: the residue of the assignment."""
    distinct = stored(tiles.select(tile).distinct(), "tiles")
    cover = cover_areas(distinct, areas, columns, tile, **options)
    # A tile whose centroid is in an area meets it, so the overlaps alone decide.
    return distinct.join(tile_overlaps(distinct, cover, columns, tile).select(tile), tile, "left_anti")
