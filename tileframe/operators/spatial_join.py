"""Spatial joins as equi-joins on covering cells, refined by exact tests in the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.functions.geometry import UNROLLED, box_overlap_area, few_edges, holds_point, holds_point_few, touches_box
from tileframe.operators.cover import BOX, CELL, EDGES, Cover, cell_id, cell_index, clamped, cover_polygons, indexable

PREDICATES = ("contains", "within", "intersects")


def join_points(
    points: DataFrame,
    polygons: DataFrame | Cover,
    columns: Sequence[str] = (),
    predicate: str = "intersects",
    x: str = "lon",
    y: str = "lat",
    keys: Mapping[str, str] | None = None,
    rings: str = "rings",
    **cover_options,
) -> DataFrame:
    """Inner join of points to the polygons around them.

    ``contains`` and ``within`` leave out points on a polygon's boundary, ``intersects`` keeps
    them, so a point on a shared border gives a row per neighbour. ``columns`` are the polygon
    columns to return. ``keys`` adds equalities, as {point column: polygon column}, to the join
    key; the polygon's copy is not returned. Points without coordinates give no rows.
    Pass a ``Cover`` to use one cover for many joins; it must hold the key columns.
    """
    if predicate not in PREDICATES:
        raise ValueError(f"predicate must be one of {PREDICATES}")
    keys = dict(keys or {})
    wanted = list(columns)
    extra = [c for c in keys.values() if c not in wanted]
    cover = (
        polygons
        if isinstance(polygons, Cover)
        else cover_polygons(polygons, [*wanted, *extra], rings=rings, **cover_options)
    )
    px, py = F.col(x), F.col(y)
    located = points.filter(indexable(px, py, cover.bits)).withColumn(
        CELL, cell_id(cell_index(px, cover.bits), cell_index(py, cover.bits))
    )
    boundary = predicate == "intersects"
    # Columns that are never NULL keep the compiled test short; ``indexable`` has dropped points without coordinates.
    nan = F.lit(float("nan"))
    located = located.withColumns({"_px": F.coalesce(px.cast("double"), nan), "_py": F.coalesce(py.cast("double"), nan)})
    near = "_px >= _w AND _px <= _e AND _py >= _s AND _py <= _n"
    looped = holds_point(EDGES, "_px", "_py", boundary)
    # A lambda keeps Spark from compiling the join, so rows of few edges, which most polygons have throughout, have a test without.
    unrolled = holds_point_few("_e", "_px", "_py", boundary)
    shapes = few_edges(EDGES, "_e")

    def joined(located: DataFrame, rows: DataFrame, exact: str) -> DataFrame:
        # Point columns keep their names; the key columns of the cover are renamed so as not to clash.
        side = rows.withColumnRenamed(CELL, "_cover_cell")
        on = F.col(CELL) == F.col("_cover_cell")
        for mine, theirs in keys.items():
            side = side.withColumn(f"_key_{theirs}", F.col(theirs))
            on = on & (F.col(mine) == F.col(f"_key_{theirs}"))
        side = side.drop(*[c for c in cover.columns if c not in wanted])
        pairs = located.join(side, on).filter(f"_whole OR ({near} AND {exact})")
        return pairs.drop(CELL, "_cover_cell", "_whole", "_px", "_py", EDGES, *shapes, *BOX, *[f"_key_{c}" for c in keys.values()])

    def simple(rows: DataFrame) -> DataFrame:
        boxed = {c: F.coalesce(F.col(c), nan) for c in BOX}
        return rows.withColumns(shapes | boxed | {"_whole": F.col(EDGES).isNull()}).drop(EDGES)

    def complex_(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_whole", F.col(EDGES).isNull())

    few = cover.most_edges is not None and cover.most_edges <= UNROLLED
    shaped, exact = (simple, unrolled) if few else (complex_, looped)
    if cover.split:
        # The points are read twice, but only those in cells with an edge are shuffled.
        edge_cells = F.broadcast(cover.outer().select(CELL).distinct())
        in_doubt = located.join(edge_cells, CELL, "left_semi")
        return joined(located, complex_(cover.inner()), "true").unionByName(joined(in_doubt, shaped(cover.outer()), exact))
    if cover.broadcast:
        return joined(located, F.broadcast(shaped(cover.rows)), exact)
    if few:
        return joined(located, simple(cover.rows), unrolled)
    many = F.coalesce(F.size(EDGES), F.lit(0)) > UNROLLED
    return joined(located, simple(cover.rows.filter(~many)), unrolled).unionByName(
        joined(located, complex_(cover.rows.filter(many)), looped)
    )


def largest_side(boxes: DataFrame, bounds: Mapping[str, Column]) -> float | None:
    """Longest side of any box: cells need not be smaller than that. One aggregate over the boxes."""
    sides = F.greatest(bounds["east"] - bounds["west"], bounds["north"] - bounds["south"])
    return boxes.agg(F.max(sides)).first()[0]


def join_boxes(
    boxes: DataFrame,
    box_key: Sequence[str],
    bounds: Mapping[str, Column],
    polygons: DataFrame | Cover,
    columns: Sequence[str],
    rings: str = "rings",
    area: str | None = None,
    **cover_options,
) -> DataFrame:
    """Pairs of boxes (for instance tiles) and polygons that meet, touching included.

    ``bounds`` gives west, south, east and north as columns of ``boxes``. Returns ``box_key``,
    ``columns`` (which must identify a polygon) and, if ``area`` names it, the common area in
    squared units of the coordinates. Each box is cut at the cell borders; tests and areas of the
    pieces are folded per pair, so no pair is formed twice and no polygon is ever handled whole.
    """
    if isinstance(polygons, Cover):
        cover = polygons
    else:
        options = {"coarsest": largest_side(boxes, bounds), **cover_options}
        cover = cover_polygons(polygons, columns, rings=rings, **options)
    bits, side = cover.bits, f"{2.0**cover.bits}D"
    framed = boxes.select(*box_key, *[bounds[b].alias(f"_{b}") for b in ("west", "south", "east", "north")])
    w, s, e, n = (F.col(f"_{b}") for b in ("west", "south", "east", "north"))
    finite = F.abs(w) + F.abs(s) + F.abs(e) + F.abs(n) < F.lit(float("inf"))

    def cells(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(cell_index(clamped(low, bits), bits), cell_index(clamped(high, bits), bits)))

    pieces = (
        framed.filter(finite)
        .select("*", cells(w, e).alias("_ix"))
        .select("*", cells(s, n).alias("_iy"))
        .withColumn(CELL, cell_id(F.col("_ix"), F.col("_iy")))
    )
    joined = pieces.join(cover.joinable(), CELL)
    box = ("_west", "_south", "_east", "_north")
    mid_x, mid_y = "((_west + _east) / 2)", "((_south + _north) / 2)"
    meets = f"""{EDGES} IS NULL OR {touches_box(EDGES, *box)} OR (
        floor({mid_x} * {side}) = _ix AND floor({mid_y} * {side}) = _iy
        AND {holds_point(EDGES, mid_x, mid_y, boundary=True)})"""
    cut = (
        f"greatest(_west, _ix / {side})", f"greatest(_south, _iy / {side})",
        f"least(_east, (_ix + 1) / {side})", f"least(_north, (_iy + 1) / {side})",
    )
    share = f"""IF({EDGES} IS NULL, ({cut[2]} - {cut[0]}) * ({cut[3]} - {cut[1]}),
        {box_overlap_area(EDGES, *cut)})"""
    folds = [F.max(F.expr(meets)).alias("_meets")]
    if area:
        folds.append(F.sum(F.expr(share)).alias(area))
    pairs = joined.groupBy(*box_key, *columns).agg(*folds)
    return pairs.filter("_meets").drop("_meets")
