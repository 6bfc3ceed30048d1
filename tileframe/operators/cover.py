"""Covers of polygons by grid cells, the equi-join key of every spatial join.

Cells are squares of side 2**-bits, so cell borders are exact doubles and a point's cell is
exact. A polygon yields one row per cell it meets: cells that no edge touches are inside as a
whole (``_edges`` is NULL, nothing to test), and the others carry just the edges of their grid
row that are not entirely to the east. Those are the only edges that the even-odd test of a
point in that cell can ever count, so the test gives the same answer as on the full polygon.
Rows also carry the polygon's bounding box, a cheap first test.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tileframe.functions.geometry import EDGE_FIELDS, EDGES_TYPE, UNROLLED, holds_point, ring_edges
from tileframe.sources.workspace import stored

CELL, EDGES = "_cell", "_edges"
BOX = ("_w", "_s", "_e", "_n")
MIN_BITS, MAX_BITS = -60, 20
_REACH = 2.0**30  # cell indexes stay below this
_MARGIN = "0.000001"  # cells this close to an edge (in cell sides) count as touched
_CELL_BYTES, _EDGE_BYTES = 128, 48
_CELLS_PER_TASK, _CELLS_PER_LARGE_TASK, _FEW_TASKS = 5_000, 200_000, 200
_FEW_CELLS, _DEEP_CELLS, _DEEP = 9, 25, 2.0  # least cells per polygon, and those where places lie in more than so many polygons
_MEASURED = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


@dataclass(frozen=True)
class Cover:
    """Cover rows (polygon columns, bounding box, ``_cell``, ``_edges``) and how they may be joined.

    ``broadcast``: all rows are within the broadcast bound. ``split``: all rows without their edges
    are, that is, the list of cells. ``most_edges`` bounds the edges of a row.
    """

    rows: DataFrame
    bits: int
    columns: tuple[str, ...]
    broadcast: bool
    split: bool = False
    most_edges: int | None = None

    def joinable(self) -> DataFrame:
        return F.broadcast(self.rows) if self.broadcast else self.rows

    def inner(self) -> DataFrame:
        """Cells wholly inside a polygon, to broadcast."""
        return F.broadcast(self.rows.filter(F.col(EDGES).isNull()))

    def outer(self) -> DataFrame:
        """Cells that an edge touches, with edges."""
        return self.rows.filter(F.col(EDGES).isNotNull())


def cell_id(ix: Column, iy: Column) -> Column:
    """Both indexes in one long."""
    return F.shiftleft(ix, 32).bitwiseOR(iy.bitwiseAND(F.lit(0xFFFFFFFF)))


def indexable(x: Column, y: Column, bits: int) -> Column:
    """False for missing and NaN coordinates, and for those that lie beyond all polygons of a cover with this grid."""
    limit = F.lit(_REACH / 2.0**bits)
    return (F.abs(x) < limit) & (F.abs(y) < limit)


def clamped(v: Column, bits: int) -> Column:
    """A coordinate of a box, moved to the border of what the grid can index; no polygon lies beyond."""
    limit = _REACH / 2.0**bits
    return F.greatest(F.lit(-limit), F.least(F.lit(limit), v))


def cell_index(v: Column, bits: int) -> Column:
    return F.floor(v * F.lit(float(2**bits))).cast("long")


def _with_box(polygons: DataFrame, rings: str, columns: Sequence[str]) -> DataFrame:
    """Edges and bounding box of each polygon; the box of an empty polygon is NULL.

    Polygons whose outer rings run clockwise throughout are turned around.
    """
    # A small file is one task, yet its polygons can be a lot of work.
    dealt = polygons.select(*columns, rings).hint("rebalance")
    edges = dealt.select(*columns, ring_edges(rings).alias(EDGES))
    fields = ", ".join(f"'{f}', e.{f}" for f in EDGE_FIELDS if f != "s")
    turned = f"""IF(aggregate({EDGES}, 0D, (a, e) -> a + e.s * (e.x1 * e.y2 - e.x2 * e.y1)) < 0,
        transform({EDGES}, e -> named_struct({fields}, 's', -e.s)), {EDGES})"""
    edges = edges.select(*columns, F.expr(turned).alias(EDGES))
    return edges.select(
        "*",
        F.expr(f"array_min(transform({EDGES}, e -> least(e.x1, e.x2)))").alias("_w"),
        F.expr(f"array_max(transform({EDGES}, e -> greatest(e.x1, e.x2)))").alias("_e"),
        F.expr(f"array_min({EDGES}.y1)").alias("_s"),
        F.expr(f"array_max({EDGES}.y2)").alias("_n"),
    )


def _has_measured_types(df: DataFrame, columns: Sequence[str]) -> bool:
    """Whether the row size of these columns is known from their types and the lengths of texts."""
    return all(kind in _MEASURED or kind.startswith("decimal") for c, kind in df.dtypes if c in columns)


def _measures(boxes: DataFrame, columns: Sequence[str]) -> list[Column]:
    """What the choice of a grid needs to know of the polygons; those without edges do not count."""
    return [
        F.expr("count(_w) AS n"),
        F.expr(f"sum(IF(_w IS NULL, 0, size({EDGES}))) AS edges"),
        F.expr(f"max(IF(_w IS NULL, 0, size({EDGES}))) AS most"),
        F.expr("sum((_e - _w) * (_n - _s)) AS wh"),
        F.expr("sum((_e - _w) + (_n - _s)) AS w_plus_h"),
        F.expr("(max(_e) - min(_w)) * (max(_n) - min(_s)) AS extent"),
        F.expr(f"max(IF(_w IS NULL, 0, {_text_size(boxes, columns)})) AS text"),
        F.max(F.greatest(*[F.abs(c) for c in BOX])).alias("reach"),
    ]


def _fits(reach: float, bits: int) -> bool:
    return reach * 2.0**bits < _REACH


def _text_size(df: DataFrame, columns: Sequence[str]) -> str:
    return " + ".join(["0", *(f"coalesce(length(`{c}`), 0)" for c, kind in df.dtypes if c in columns and kind == "string")])


@dataclass(frozen=True)
class Grid:
    """A grid for a polygon table, and upper bounds of what the cover will hold."""

    bits: int
    polygons: int
    edges: int
    cells: int
    text: int  # longest text of the polygon columns
    most: int  # most edges of a polygon
    deep: bool = False  # a fine grid for polygons that overlap


def choose_grid(
    found: Mapping[str, float], cells_per_polygon: int | None, least_cells: int, coarsest: float | None = None, limit: int = 0
) -> Grid:
    """Finest grid within a cell budget, from the measures of the polygon boxes.

    The finer the grid, the more points fall in cells that need no test, which pays for polygons of
    many edges: unless given, the budget is two cells per edge, within 9 to 64 cells per polygon. Where polygons overlap, so that
    a point meets many, and their cover goes beyond ``limit`` bytes anyway, it is 25 at least: at 9 a point would meet five polygons
    of its cell for each one around it. ``coarsest`` keeps the cell side at or above a given size (used when the other side has
    boxes, not points).
    """
    # (w k + 2)(h k + 2) bounds the cells of one polygon at k cells per unit; its sum over all
    # polygons needs three sums only, whatever k.
    row, n = found, found.get("n")
    if not n:
        return Grid(0, 0, 0, 0, 0, 0)

    def cells(bits: int) -> int:
        return int(row["wh"] * 4.0**bits + 2 * row["w_plus_h"] * 2.0**bits + 4 * n)

    allowed = [
        b for b in range(MIN_BITS, MAX_BITS + 1) if _fits(row["reach"], b) and not (coarsest and 2.0**-b < coarsest)
    ]
    if not allowed:
        raise ValueError(f"no grid holds coordinates up to {row['reach']} and boxes up to {coarsest}")

    deep = row["wh"] > _DEEP * row["extent"] and _FEW_CELLS * n * _CELL_BYTES > limit
    each = cells_per_polygon or min(64, max(_DEEP_CELLS if deep else _FEW_CELLS, 2 * row["edges"] // n))
    # Four cells a polygon is what the coarsest grids need at most.
    budget = max(each * n, 5 * n, least_cells)
    bits = max((b for b in allowed if cells(b) <= budget), default=allowed[0])
    return Grid(bits, n, row["edges"], cells(bits), row["text"], row["most"], deep and not cells_per_polygon)


def _cover_rows(boxes: DataFrame, bits: int, columns: Sequence[str], tasks: int = 1) -> DataFrame:
    """One row per polygon and cell. With several ``tasks`` the strips, each with its own edges only, are dealt
    out to so many; otherwise nothing is shuffled."""
    side = f"{2.0**bits}D"
    strips = boxes.select(
        *columns, *BOX, EDGES, F.expr(f"explode(sequence(floor(_s * {side}), floor(_n * {side}))) AS _iy")
    )
    bottom, top = f"(_iy / {side})", f"((_iy + 1) / {side})"
    slope = "try_divide(e.x2 - e.x1, e.y2 - e.y1)"
    # Where an edge enters and leaves the strip: the range of x it can touch there.
    enter = f"IF(e.y1 < {bottom}, e.x1 + {slope} * ({bottom} - e.y1), e.x1)"
    leave = f"IF(e.y2 > {top}, e.x2 - {slope} * (e.y2 - {top}), e.x2)"
    fields = ", ".join(f"'{f}', e.{f}" for f in EDGE_FIELDS)
    in_strip = f"""transform(filter({EDGES}, e -> e.y1 < {top} AND e.y2 >= {bottom}), e -> named_struct(
        {fields}, 'xa', least({enter}, {leave}), 'xb', greatest({enter}, {leave})))"""
    strips = strips.select(*columns, *BOX, "_iy", F.expr(in_strip).alias(EDGES))
    if tasks > 1:
        strips = strips.repartition(tasks)
    west = f"floor(array_min({EDGES}.xa) * {side} - {_MARGIN}D)"
    east = f"floor(array_max({EDGES}.xb) * {side} + {_MARGIN}D)"
    touched = f"exists({EDGES}, e -> e.xa * {side} <= ix + 1 + {_MARGIN}D AND e.xb * {side} >= ix - {_MARGIN}D)"
    middle = holds_point(EDGES, f"((c.ix + 0.5D) / {side})", f"((_iy + 0.5D) / {side})", boundary=False)
    cells = strips.select(
        "*",
        F.expr(
            f"""explode(filter(
                transform(sequence({west}, {east}), ix -> named_struct('ix', ix, 'touched', {touched})),
                c -> c.touched OR {middle})) AS _c"""
        ),
    )
    near = f"""transform(
        filter({EDGES}, e -> least(e.x1, e.x2) * {side} <= _c.ix + 1), e -> named_struct({fields}))"""
    return cells.select(
        *columns,
        *BOX,
        cell_id(F.col("_c.ix"), F.col("_iy")).alias(CELL),
        F.expr(f"CAST(IF(_c.touched, {near}, NULL) AS {EDGES_TYPE})").alias(EDGES),
    )


def _session_broadcast_limit(df: DataFrame, limit: int) -> int:
    """The caller's bound, or none at all where the session switches broadcasts off."""
    setting = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    return 0 if setting.strip().startswith("-") else limit


def cover_polygons(
    polygons: DataFrame,
    columns: Sequence[str],
    rings: str = "rings",
    bits: int | None = None,
    cells_per_polygon: int | None = None,
    least_cells: int = 50_000,
    coarsest: float | None = None,
    broadcast_bytes: int = 64 << 20,
) -> Cover:
    """Cover a polygon table. ``columns`` are the polygon columns that joins shall return.

    The edges and boxes of the polygons are written once; what is measured meanwhile picks the grid and bounds the size of the cover.

    * A cover within ``broadcast_bytes`` is written once, measured while it is written, and broadcast.
    * Few polygons of many edges, as administrative areas are, can have a small list of cells all the
      same. Then the cells inside a polygon are broadcast, and only points in cells with an edge are
      shuffled.
    * Columns whose size no type tells (arrays, structs, maps, binary) rule out a broadcast.
    * Many polygons, as a country's buildings are, join by shuffle on the cell; AQE splits hot cells.
    """
    columns = tuple(columns)
    boxes = _with_box(polygons, rings, columns)
    limit = _session_broadcast_limit(polygons, broadcast_bytes) if _has_measured_types(boxes, columns) else 0
    measured = Observation()
    boxes = stored(boxes.observe(measured, *_measures(boxes, columns)), "boxes")
    found = measured.get
    most = found.get("most") or 0
    fits_edges, fits_cells, tasks = True, False, 1
    if bits is None:
        grid = choose_grid(found, cells_per_polygon, least_cells, coarsest, limit)
        bits = grid.bits
        # A small file is one task, yet its cover can be a lot of work.
        tasks = min(grid.cells // _CELLS_PER_TASK, max(_FEW_TASKS, grid.cells // _CELLS_PER_LARGE_TASK))
        fits_edges = grid.polygons * _CELL_BYTES + grid.edges * _EDGE_BYTES <= limit
        fits_cells = grid.cells * (_CELL_BYTES + (grid.text or 0)) <= limit
        if grid.deep:
            limit = 0
    else:
        reach = found.get("reach")
        if reach is not None and not _fits(reach, bits):
            raise ValueError(f"a grid of {bits} bits does not hold coordinates up to {reach}")
    rows = _cover_rows(boxes, bits, columns, tasks)
    if limit <= 0 or not (fits_edges or fits_cells):
        # Rows of few and of many edges are joined apart, so the cover is read twice.
        rows = stored(rows, "cover") if most > UNROLLED else rows
        return Cover(rows, bits, columns, broadcast=False, most_edges=most)
    size = Observation()
    bytes_ = f"sum({_CELL_BYTES} + {_text_size(rows, columns)} + coalesce(size({EDGES}), 0) * {_EDGE_BYTES})"
    kept = stored(rows.observe(size, F.expr(bytes_).alias("bytes")), "cover")
    whole = (size.get["bytes"] or 0) <= limit
    return Cover(kept, bits, columns, broadcast=whole, split=fits_cells and not whole, most_edges=most)
