"""Planar polygon expressions on plain structs, evaluated in the JVM.

A polygon is ``rings: array<array<struct<x,y>>>``: all rings of all parts, outer rings
counter-clockwise and holes clockwise, so that signed sums over rings need no nesting.
An edge is ``struct<x1,y1,x2,y2,s>`` turned to point upwards (to the right if level), with
``s`` = +1 or -1 for its direction in the ring. Neighbours that share an edge therefore
evaluate the very same arithmetic on it, and rounding cannot put a point in both or neither.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"
EDGES_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double,s:int>>"

EDGE_FIELDS = ("x1", "y1", "x2", "y2", "s")

_ON_EDGE = 1 << 20

#: Most edges that ``holds_point_few`` tests.
UNROLLED = 6


def _ring_area2(ring: Column) -> Column:
    """Twice the signed area of a closed ring, taken relative to its first point."""
    first = F.get(ring, F.lit(0))
    terms = F.transform(
        F.sequence(F.lit(1), F.size(ring) - 1),
        lambda i: (F.get(ring, i - 1)["x"] - first["x"]) * (F.get(ring, i)["y"] - first["y"])
        - (F.get(ring, i)["x"] - first["x"]) * (F.get(ring, i - 1)["y"] - first["y"]),
    )
    return F.when(F.size(ring) >= 2, F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)).otherwise(F.lit(0.0))


def close_ring(ring: Column) -> Column:
    return F.when(F.get(ring, F.lit(0)) == F.get(ring, F.size(ring) - 1), ring).otherwise(
        F.concat(ring, F.slice(ring, 1, 1))
    )


def oriented(ring: Column, hole: Column) -> Column:
    """Outer rings counter-clockwise, holes clockwise."""
    wrong = (_ring_area2(ring) < 0) != hole
    return F.when(wrong, F.reverse(ring)).otherwise(ring)


def rings_from_wkt(wkt: Column) -> Column:
    """POLYGON or MULTIPOLYGON text to rings; NULL for other text or a malformed number."""
    is_polygon = F.upper(wkt).rlike("^\\s*(MULTI)?POLYGON\\b")
    opening = F.regexp_extract_all(wkt, F.lit("(\\(\\s*)*\\(([^()]+)\\)"), F.lit(0))

    def point(text: Column) -> Column:
        xy = F.split(F.trim(text), "\\s+")
        return F.struct(F.get(xy, 0).try_cast("double").alias("x"), F.get(xy, 1).try_cast("double").alias("y"))

    def ring(text: Column) -> Column:
        hole = ~text.rlike("^\\(\\s*\\(")
        points = F.transform(F.split(F.regexp_replace(text, "[()]", ""), ","), point)
        return oriented(close_ring(points), hole)

    rings = F.transform(opening, ring)
    bad = F.exists(F.flatten(rings), lambda p: p["x"].isNull() | p["y"].isNull())
    return F.when(is_polygon & ~bad, rings).cast(RINGS_TYPE)


def ring_edges(rings: str) -> Column:
    """All edges of all rings of a column, turned upwards; edges without length are left out."""
    up = "(a.y < b.y OR (a.y = b.y AND a.x <= b.x))"
    fields = f"""
        'x1', IF({up}, a.x, b.x), 'y1', IF({up}, a.y, b.y),
        'x2', IF({up}, b.x, a.x), 'y2', IF({up}, b.y, a.y), 's', IF({up}, 1, -1)"""
    per_ring = f"zip_with(slice(r, 1, size(r) - 1), slice(r, 2, size(r) - 1), (a, b) -> named_struct({fields}))"
    return F.expr(
        f"""CAST(filter(
            flatten(transform(filter({rings}, r -> size(r) >= 2), r -> {per_ring})),
            e -> e.x1 <> e.x2 OR e.y1 <> e.y2
        ) AS {EDGES_TYPE})"""
    )


def polygon_area(rings: Column) -> Column:
    return F.aggregate(rings, F.lit(0.0), lambda a, r: a + _ring_area2(r)) / 2


def polygon_centroid(rings: Column) -> dict[str, Column]:
    """Planar centroid by the shoelace sums, relative to the first point for accuracy."""
    origin = F.get(F.get(rings, F.lit(0)), F.lit(0))

    def moment(axis: str) -> Column:
        def of_ring(r: Column) -> Column:
            terms = F.transform(
                F.sequence(F.lit(1), F.size(r) - 1),
                lambda i: (F.get(r, i - 1)[axis] + F.get(r, i)[axis] - 2 * origin[axis])
                * (
                    (F.get(r, i - 1)["x"] - origin["x"]) * (F.get(r, i)["y"] - origin["y"])
                    - (F.get(r, i)["x"] - origin["x"]) * (F.get(r, i - 1)["y"] - origin["y"])
                ),
            )
            return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)

        return F.aggregate(rings, F.lit(0.0), lambda a, r: a + of_ring(r))

    area6 = polygon_area(rings) * 6
    return {axis: origin[axis] + F.try_divide(moment(axis), area6) for axis in ("x", "y")}


# The tests below take SQL text (column names or expressions) and return SQL text: one parse
# in the JVM instead of thousands of calls to build the same tree node by node.


def holds_point(edges: str, px: str, py: str, boundary: bool) -> str:
    """Even-odd test. ``boundary`` says whether a point on an edge counts.

    Counts the edges to the left of the point, plus a large even mark for each edge it lies on.
    """
    side = f"((e.x2 - e.x1) * ({py} - e.y1) - ({px} - e.x1) * (e.y2 - e.y1))"
    verdict = f"n >= {_ON_EDGE} OR n % 2 = 1" if boundary else f"n < {_ON_EDGE} AND n % 2 = 1"
    return f"""aggregate({edges}, 0, (n, e) -> CASE
        WHEN {py} < e.y1 OR {py} > e.y2 THEN n
        WHEN {side} < 0 THEN IF({py} < e.y2, n + 1, n)
        WHEN {side} = 0 AND {px} >= least(e.x1, e.x2) AND {px} <= greatest(e.x1, e.x2) THEN n + {_ON_EDGE}
        ELSE n END, n -> {verdict})"""


def few_edges(edges: str, name: str) -> dict[str, Column]:
    """Edges as plain columns for ``holds_point_few``, four for each of ``UNROLLED``; what is missing lies above all points."""
    axes = {"x1": 0.0, "y1": float("inf"), "x2": 0.0, "y2": 0.0}
    return {
        f"{name}{i}_{axis}": F.coalesce(F.get(F.col(edges), F.lit(i))[axis], F.lit(missing))
        for i in range(UNROLLED) for axis, missing in axes.items()
    }


def holds_point_few(name: str, px: str, py: str, boundary: bool) -> str:
    """``holds_point`` on the columns of ``few_edges``: the same arithmetic, in code that is compiled with a join and small
    enough to be compiled to machine code."""
    mark = 2 * UNROLLED  # even, and above all counts of crossings

    def counted(e: str) -> str:
        side = f"(({e}_x2 - {e}_x1) * ({py} - {e}_y1) - ({px} - {e}_x1) * ({e}_y2 - {e}_y1))"
        return f"""CASE WHEN {py} < {e}_y1 OR {py} > {e}_y2 THEN 0
            WHEN {side} < 0 THEN IF({py} < {e}_y2, 1, 0)
            WHEN {side} = 0 AND ({px} >= {e}_x1 OR {px} >= {e}_x2) AND ({px} <= {e}_x1 OR {px} <= {e}_x2) THEN {mark}
            ELSE 0 END"""

    total = " + ".join(counted(f"{name}{i}") for i in range(UNROLLED))
    odd = ", ".join(str(n) for n in range(1, UNROLLED + 1, 2))
    even = ", ".join(str(n) for n in range(0, UNROLLED + 1, 2))
    return f"({total}) NOT IN ({even})" if boundary else f"({total}) IN ({odd})"


def touches_box(edges: str, west: str, south: str, east: str, north: str) -> str:
    """True if any edge meets the closed box."""

    def side(x: str, y: str) -> str:
        return f"((e.x2 - e.x1) * ({y} - e.y1) - ({x} - e.x1) * (e.y2 - e.y1))"

    corners = ", ".join([side(west, south), side(west, north), side(east, north), side(east, south)])
    return f"""exists({edges}, e ->
        e.y1 <= {north} AND e.y2 >= {south}
        AND least(e.x1, e.x2) <= {east} AND greatest(e.x1, e.x2) >= {west}
        AND least({corners}) <= 0 AND greatest({corners}) >= 0)"""


def box_overlap_area(edges: str, west: str, south: str, east: str, north: str) -> str:
    """Area of polygon and box in common.

    Summed edge by edge: each edge contributes the box area between it and the eastern
    side, signed by its direction. Edges east of the box contribute nothing.
    """
    low, high = f"greatest(e.y1, {south})", f"least(e.y2, {north})"

    def gap(y: str) -> str:
        """Distance from the edge, at height y, to the eastern side."""
        return f"({east} - (e.x1 + try_divide(e.x2 - e.x1, e.y2 - e.y1) * ({y} - e.y1)))"

    # Mean width over an edge piece whose gap runs from ``near`` to ``far``, held within 0..width.
    over = "greatest(c.far - greatest(c.near, c.width), 0D) * c.width"
    start, stop = "greatest(c.near, 0D)", "least(c.far, c.width)"
    sloped = f"greatest({stop} - {start}, 0D) * ({start} + {stop}) / 2"
    mean = f"""IF(c.far > c.near, try_divide({over} + {sloped}, c.far - c.near),
        least(greatest(c.near, 0D), c.width))"""
    pieces = f"""transform(filter({edges}, e -> {high} > {low}), e -> named_struct(
        'near', least({gap(low)}, {gap(high)}), 'far', greatest({gap(low)}, {gap(high)}),
        'width', {east} - {west}, 'signed', -e.s * ({high} - {low})))"""
    return f"aggregate({pieces}, 0D, (total, c) -> total + c.signed * {mean})"
