import math
import random
import re

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tileframe.functions import geometry
from tileframe.operators import assign, cover, spatial_join

POLYGON_SCHEMA = f"name string, kind string, rings {geometry.RINGS_TYPE}"


def ring(points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def star(rng, cx, cy, size, corners):
    """A simple polygon, usually concave, counter-clockwise around its centre."""
    angles = [2 * math.pi * (i + rng.uniform(0, 0.3)) / corners for i in range(corners)]
    radii = [size * rng.uniform(0.3, 1) for _ in angles]
    return [(cx + r * math.cos(a), cy + r * math.sin(a)) for r, a in zip(radii, angles)]


def side(p, a, b):
    """Evaluated on the upward edge, as in the library."""
    if (a[1], a[0]) > (b[1], b[0]):
        a, b = b, a
    return (b[0] - a[0]) * (p[1] - a[1]) - (p[0] - a[0]) * (b[1] - a[1])


def locate(p, rings):
    """inside, edge or outside, by brute force over all edges."""
    odd = False
    for points in rings:
        for a, b in zip(points, points[1:] + points[:1]):
            s = side(p, a, b)
            lo, hi = sorted((a[1], b[1]))
            if s == 0 and lo <= p[1] <= hi and min(a[0], b[0]) <= p[0] <= max(a[0], b[0]):
                return "edge"
            odd ^= lo <= p[1] < hi and s < 0
    return "inside" if odd else "outside"


SQUARE = [(0, 0), (4, 0), (4, 4), (0, 4)]
HOLE = [(1, 1), (1, 2), (2, 2), (2, 1)]
ELL = [(10, 0), (14, 0), (14, 2), (12, 2), (12, 4), (10, 4)]
NEXT = [(4, 0), (8, 0), (8, 4), (4, 4)]


@pytest.fixture(scope="module")
def shapes(spark):
    rng = random.Random(3)
    rings = {"square": [SQUARE, HOLE], "ell": [ELL], "next": [NEXT]}
    for i in range(25):
        rings[f"star{i}"] = [star(rng, rng.uniform(0, 16), rng.uniform(-4, 8), rng.uniform(0.05, 4), rng.randint(3, 40))]
    rows = [(n, n[0], [ring(r) for r in rs]) for n, rs in rings.items()]
    return rings, spark.createDataFrame(rows, POLYGON_SCHEMA)


@pytest.fixture(scope="module")
def points(spark, shapes):
    rng = random.Random(4)
    pts = [(x / 2, y / 2) for x in range(-2, 30) for y in range(-2, 10)]
    pts += [p for rs in shapes[0].values() for r in rs for p in r]
    pts += [(rng.uniform(-1, 16), rng.uniform(-5, 9)) for _ in range(1500)]
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    odd = [(-1, None, 1.0), (-2, 1.0, None), (-3, float("nan"), 1.0), (-4, 1e300, 1.0), (-5, float("inf"), 0.5)]
    return pts, spark.createDataFrame([*pts, *odd], "id int, lon double, lat double")


@pytest.mark.parametrize("options", [{}, {"bits": 0}, {"bits": 5}, {"broadcast_bytes": 0}])
def test_joins_equal_brute_force(shapes, points, options):
    rings, polygons = shapes
    pts, df = points
    where = {(i, n): locate((x, y), rs) for i, x, y in pts for n, rs in rings.items()}
    for predicate, kept in (("contains", ("inside",)), ("intersects", ("inside", "edge"))):
        got = spatial_join.join_points(df, polygons, ["name"], predicate, **options).select("id", "name").collect()
        want = {pair for pair, place in where.items() if place in kept}
        assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_shared_edge_belongs_to_both_or_none(spark, shapes):
    df = spark.createDataFrame([(1, 4.0, 2.0), (2, 1.5, 1.5), (3, 1.0, 1.5), (4, 13.0, 3.0)], "id int, lon double, lat double")
    polygons = shapes[1].filter("name IN ('square', 'next', 'ell')")
    closed = spatial_join.join_points(df, polygons, ["name"], "intersects")
    assert sorted((r.id, r.name) for r in closed.collect()) == [(1, "next"), (1, "square"), (3, "square")]
    assert spatial_join.join_points(df, polygons, ["name"], "within").count() == 0
    with pytest.raises(ValueError):
        spatial_join.join_points(df, polygons, ["name"], "near")


def test_keyed_join(spark, shapes):
    df = spark.createDataFrame([(1, 3.0, 3.0, "s"), (2, 3.0, 3.0, "e"), (3, 5.0, 1.0, None)], "id int, lon double, lat double, zone string")
    polygons = shapes[1].filter("name IN ('square', 'next', 'ell')")
    got = spatial_join.join_points(df, polygons, ["name"], "intersects", keys={"zone": "kind"})
    assert got.columns == ["id", "lon", "lat", "zone", "name"]
    assert [(r.id, r.name) for r in got.collect()] == [(1, "square")]
    same = spatial_join.join_points(
        df.withColumnRenamed("zone", "kind"), polygons, ["name"], "intersects", keys={"kind": "kind"}, broadcast_bytes=0
    )
    assert [(r.id, r.kind, r.name) for r in same.collect()] == [(1, "s", "square")]


def test_cover_is_broadcast_only_within_its_bound(shapes, points):
    small = spatial_join.join_points(points[1], shapes[1], ["name"])
    large = spatial_join.join_points(points[1], shapes[1], ["name"], broadcast_bytes=1000)
    assert cover.cover_polygons(shapes[1], ["name"]).broadcast
    assert not cover.cover_polygons(shapes[1], ["name"], broadcast_bytes=1000).broadcast
    for df in (small, large):
        plan = plan_of(df)
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan
    assert "Exchange hashpartitioning" not in plan_of(small)


def test_many_edges_few_cells(spark, points):
    """The cells fit in a broadcast, the edges do not: only points in cells with an edge are shuffled."""
    rng = random.Random(8)
    rings = {f"s{i}": [star(rng, rng.uniform(0, 16), rng.uniform(-4, 8), rng.uniform(2, 4), 300)] for i in range(10)}
    rows = [(n, n[0], [ring(r) for r in rs]) for n, rs in rings.items()]
    polygons = spark.createDataFrame(rows, POLYGON_SCHEMA)
    options = {"cells_per_polygon": 60, "least_cells": 0, "broadcast_bytes": 110_000}
    built = cover.cover_polygons(polygons, ["name"], **options)
    assert built.split and not built.broadcast
    for predicate, kept in (("contains", ("inside",)), ("intersects", ("inside", "edge"))):
        joined = spatial_join.join_points(points[1], polygons, ["name"], predicate, **options)
        got = [tuple(r) for r in joined.select("id", "name").collect()]
        want = {(i, n) for i, x, y in points[0] for n, rs in rings.items() if locate((x, y), rs) in kept}
        assert len(got) == len(want) and set(got) == want
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and "LeftSemi" in plan and "CartesianProduct" not in plan


def test_clockwise_rings_have_the_same_overlaps(spark):
    polygons = spark.createDataFrame([("a", "k", [ring(SQUARE[::-1]), ring(HOLE[::-1])])], POLYGON_SCHEMA)
    boxes = spark.createDataFrame([(1, 0.5, 0.5, 1.5, 1.5)], "b int, w double, s double, e double, n double")
    bounds = dict(zip(("west", "south", "east", "north"), map(F.col, "wsen")))
    pairs = spatial_join.join_boxes(boxes, ["b"], bounds, polygons, ["name"], area="area")
    assert pairs.first().area == pytest.approx(0.75)


def test_hot_cell_keeps_all_rows(spark, shapes):
    """Two thirds of the points in one spot."""
    df = spark.range(30000).selectExpr("id", "IF(id % 3 = 0, 12.5D, 3.5D) AS lon", "IF(id % 3 = 0, 1D, 3.5D) AS lat")
    polygons = shapes[1].filter("name IN ('square', 'next', 'ell')")
    for options in ({}, {"broadcast_bytes": 0}):
        joined = spatial_join.join_points(df, polygons, ["name"], **options)
        assert {(r.name, r["count"]) for r in joined.groupBy("name").count().collect()} == {("square", 20000), ("ell", 10000)}


def test_wkt(spark):
    texts = [
        "POLYGON ((0 0, 0 4, 4 4, 4 0, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))",
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((5 5, 8 5, 8 8, 5 5)))",
        " polygon((0 0,2 0,2 2,0 2))",
        "POINT (1 2)",
        "POLYGON ((0 0, a 1, 2 2, 0 0))",
        None,
        "POLYGON EMPTY",
        "POLYGON ((1e1 -2.5E0 7, 12 -2.5 7, 12 0 7, 10 -2.5 7))",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, wkt string")
    loaded = df.select("id", geometry.rings_from_wkt(F.col("wkt")).alias("rings"))
    c = geometry.polygon_centroid(F.col("rings"))
    rows = loaded.select(
        "id", "rings", geometry.polygon_area(F.col("rings")).alias("a"), c["x"].alias("x"), F.size(geometry.ring_edges("rings")).alias("n")
    ).orderBy("id").collect()
    assert [r.a for r in rows] == [15.0, 5.5, 4.0, None, None, None, 0.0, 2.5]
    assert rows[0].x == pytest.approx((16 * 2 - 1.5) / 15) and rows[1].x == pytest.approx((0.5 + 4.5 * 7) / 5.5)
    assert [r.n for r in rows[:3]] == [8, 7, 4]
    assert rows[2].rings[0][0] == rows[2].rings[0][-1]


def clip(points, keep, cut):
    out = []
    for a, b in zip(points, points[1:] + points[:1]):
        if keep(a):
            out.append(a)
        if keep(a) != keep(b):
            out.append(cut(a, b))
    return out


def clipped_area(points, w, s, e, n):
    """Area in common with a box: four half-plane cuts, then the shoelace sum."""
    def at(axis, v):
        def cut(a, b):
            t = (v - a[axis]) / (b[axis] - a[axis])
            return tuple(v if i == axis else a[i] + t * (b[i] - a[i]) for i in (0, 1))
        return cut

    for keep, cut in (
        (lambda p: p[0] >= w, at(0, w)), (lambda p: p[0] <= e, at(0, e)),
        (lambda p: p[1] >= s, at(1, s)), (lambda p: p[1] <= n, at(1, n)),
    ):
        points = clip(points, keep, cut)
        if not points:
            return 0.0
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1])) / 2


@pytest.mark.parametrize("options", [{}, {"bits": 3}, {"broadcast_bytes": 0}])
def test_overlap_areas(spark, shapes, options):
    rings, polygons = shapes
    rng = random.Random(5)
    boxes = [(i, x, y, x + rng.uniform(0.1, 3), y + rng.uniform(0.1, 3)) for i in range(60) for x, y in [(rng.uniform(-2, 16), rng.uniform(-5, 8))]]
    boxes += [(100, 4.0, 4.0, 5.0, 5.0), (101, -9.0, -9.0, 30.0, 30.0), (102, 1.2, 1.2, 1.4, 1.4), (103, 2.5, 2.5, 3.0, 3.0)]
    df = spark.createDataFrame(boxes, "b int, w double, s double, e double, n double")
    bounds = dict(zip(("west", "south", "east", "north"), map(F.col, "wsen")))
    got = {(r.b, r.name): r.area for r in spatial_join.join_boxes(df, ["b"], bounds, polygons, ["name"], area="area", **options).collect()}
    for b, *box in boxes:
        for name, rs in rings.items():
            want = sum(clipped_area(list(r), *box) for r in rs)
            if want > 1e-9:
                assert got[(b, name)] == pytest.approx(want, abs=1e-9)
            else:
                assert got.get((b, name), 0.0) == pytest.approx(0.0, abs=1e-9)
    assert (100, "square") in got and (100, "next") in got  # touching counts
    assert (102, "square") not in got  # wholly in the hole
    assert got[(103, "square")] == pytest.approx(0.25)


def test_assignment_of_tiles(spark):
    """Zoom-3 tiles are 45 degrees wide: centroid first, then the largest overlap, else nothing."""
    def box(w, s, e, n):
        return [ring([(w, s), (e, s), (e, n), (w, n)])]

    areas = spark.createDataFrame(
        [("a", "x", box(0, 0, 30, 40)), ("b", "x", box(30, 0, 50, 40)), ("c", "y", box(89, 1, 95, 9)),
         ("d", "y", box(90, 10, 94, 38)), ("e", "y", box(50, 0, 60, 5))],
        POLYGON_SCHEMA,
    )
    # Tile 122 spans 0-45 by 0-41; 123 spans 45-90 (touches b, e, c and, at its border, d); 132 spans 90-135.
    tiles = spark.createDataFrame([("122",), ("122",), ("123",), ("132",), ("300",), ("000",)], "tile string")
    got = {r.tile: r.name for r in assign.assign_tiles(tiles, areas, ["name"]).collect()}
    # 300 lies south of the equator and touches a and b along it: equal overlaps of zero, so the first by name.
    assert got == {"122": "a", "123": "b", "132": "d", "300": "a"}
    assert [r.tile for r in assign.unassigned_tiles(tiles, areas, ["name"]).collect()] == ["000"]


def test_empty_inputs(spark, shapes, points):
    none = shapes[1].limit(0)
    assert spatial_join.join_points(points[1], none, ["name"]).count() == 0
    assert spatial_join.join_points(points[1].limit(0), shapes[1], ["name"]).count() == 0


@pytest.mark.parametrize("options", [{}, {"bits": 8}, {"bits": -3}, {"broadcast_bytes": 0}])
def test_coordinates_in_metres(spark, options):
    """Small polygons far from the origin; the grid follows from where they lie."""
    far = [(600_000 + x, 1_500_000 + y) for x, y in SQUARE]
    shapes = spark.createDataFrame([("far", "f", [ring(far)])], POLYGON_SCHEMA)
    points = spark.createDataFrame([(1, 600_001.0, 1_500_001.0), (2, 0.0, 0.0), (3, 1e12, 0.0)], "id int, lon double, lat double")
    assert [r.id for r in spatial_join.join_points(points, shapes, ["name"], **options).collect()] == [1]


def test_grid_without_room_is_refused(spark):
    shapes = spark.createDataFrame([("far", "f", [ring([(600_000 + x, 1_500_000 + y) for x, y in SQUARE])])], POLYGON_SCHEMA)
    with pytest.raises(ValueError, match="does not hold"):
        cover.cover_polygons(shapes, ["name"], bits=12)


def test_wide_area_has_a_bounded_cover(spark):
    wide = [(0, 0), (500_000, 0), (500_000, 500_000), (0, 500_000)]
    shapes = spark.createDataFrame([("wide", "w", [ring(wide)])], POLYGON_SCHEMA)
    found = cover.cover_polygons(shapes, ["name"])
    assert found.bits < 0 and found.rows.count() < 60_000


def test_box_beyond_the_grid_meets_its_polygon(spark):
    shapes = spark.createDataFrame([("square", "s", [ring(SQUARE)])], POLYGON_SCHEMA)
    boxes = spark.createDataFrame([(1, -1e12, -1e12, 1e12, 1e12), (2, 1e11, 1e11, 1e12, 1e12)], "id int, w double, s double, e double, n double")
    bounds = {"west": F.col("w"), "south": F.col("s"), "east": F.col("e"), "north": F.col("n")}
    out = spatial_join.join_boxes(boxes, ["id"], bounds, shapes, ["name"], area="area").collect()
    assert [(r.id, r.name, r.area) for r in out] == [(1, "square", 16.0)]


def test_no_broadcast_of_columns_without_a_known_size(spark, shapes):
    tagged = shapes[1].withColumn("tags", F.array_repeat(F.lit("x"), 1000))
    found = cover.cover_polygons(tagged, ["name", "tags"])
    assert not found.broadcast and not found.split


def boxes_and_ells(rng, n, spread=1.0, size=0.2):
    """Small polygons of four and six edges that overlap."""
    out = {}
    for i in range(n):
        x, y, h = round(rng.uniform(0, spread), 2), round(rng.uniform(0, spread), 2), rng.choice([size / 4, size / 2, size])
        corners = [(-1, -1), (1, -1), (1, 0), (0, 0), (0, 1), (-1, 1)] if i % 3 == 0 else [(-1, -1), (1, -1), (1, 1), (-1, 1)]
        out[f"b{i}"] = [[(x + a * h, y + b * h) for a, b in corners]]
    return out


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "bits": 1}])
def test_few_edges_equal_brute_force_and_compile(spark, options):
    """Borders, corners and insides; the join of polygons of few edges is compiled, whatever the grid."""
    rng = random.Random(9)
    rings = boxes_and_ells(rng, 60)
    polygons = spark.createDataFrame([(n, n[0], [ring(r) for r in rs]) for n, rs in rings.items()], POLYGON_SCHEMA)
    pts = [p for rs in rings.values() for r in rs for p in r] + [(rng.uniform(-0.3, 1.3), rng.uniform(-0.3, 1.3)) for _ in range(400)]
    pts += [((a[0] + b[0]) / 2, (a[1] + b[1]) / 2) for rs in rings.values() for r in rs for a, b in zip(r, r[1:])]
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(pts)]
    df = spark.createDataFrame([*pts, (-1, None, 0.5), (-2, 0.5, float("nan"))], "id int, lon double, lat double")
    where = {(i, n): locate((x, y), rs) for i, x, y in pts for n, rs in rings.items()}
    for predicate, kept in (("within", ("inside",)), ("intersects", ("inside", "edge"))):
        joined = spatial_join.join_points(df, polygons, ["name"], predicate, **options)
        assert joined.columns == ["id", "lon", "lat", "name"]
        got = [tuple(r) for r in joined.select("id", "name").collect()]
        want = {pair for pair, place in where.items() if place in kept}
        assert len(got) == len(want) and set(got) == want
    plan = plan_of(joined)
    assert re.search(r"\*\(\d+\) (SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[_cell", plan)


def test_few_and_many_edges_side_by_side(spark):
    """Rows of more edges than the compiled test takes keep the other one, polygon by polygon and cell by cell."""
    rng = random.Random(10)
    rings = boxes_and_ells(rng, 30) | {f"s{i}": [star(rng, rng.uniform(0, 1), rng.uniform(0, 1), 0.3, 30)] for i in range(8)}
    polygons = spark.createDataFrame([(n, n[0], [ring(r) for r in rs]) for n, rs in rings.items()], POLYGON_SCHEMA)
    pts = [(i, rng.uniform(-0.3, 1.3), rng.uniform(-0.3, 1.3)) for i in range(600)]
    df = spark.createDataFrame(pts, "id int, lon double, lat double")
    for bits in (2, 5):
        joined = spatial_join.join_points(df, polygons, ["name"], "within", bits=bits, broadcast_bytes=0)
        got = [tuple(r) for r in joined.select("id", "name").collect()]
        want = {(i, n) for i, x, y in pts for n, rs in rings.items() if locate((x, y), rs) == "inside"}
        assert len(got) == len(want) and set(got) == want


def test_overlapping_polygons_get_a_fine_grid(spark):
    """At 25 cells a box is at least 1.5 cells wide, so at most (2.5 / 1.5) ** 2 = 2.78 pairs share a cell for each that meets; at 9 cells
    it is five here."""
    shapes = spark.range(6000).selectExpr("id AS name", "(id * 7919 % 100003) / 100003D AS x", "(id * 15485863 % 99991) / 99991D AS y")
    corners = "array(array(0, 0), array(1, 0), array(1, 1), array(0, 1), array(0, 0))"
    polygons = shapes.selectExpr(
        "name", f"CAST(array(transform({corners}, c -> named_struct('x', x + c[0] * 0.05D, 'y', y + c[1] * 0.05D))) AS {geometry.RINGS_TYPE}) AS rings")
    found = cover.cover_polygons(polygons, ["name"], least_cells=0, broadcast_bytes=1_000_000)
    met = found.rows.count() * 4.0**-found.bits
    assert not found.broadcast and met < 2.78 * 6000 * 0.05**2
    apart = polygons.selectExpr("name", "transform(rings, r -> transform(r, p -> named_struct('x', p.x + name, 'y', p.y))) AS rings")
    assert cover.cover_polygons(apart, ["name"], least_cells=0, broadcast_bytes=1_000_000).bits < found.bits
