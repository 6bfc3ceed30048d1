import math
import random

from pyspark.sql import functions as F

from tileframe.functions import cells
from tileframe.operators import features


def _tile(lat, lon, zoom):
    """Plain Python twin of the tile scheme."""
    s = math.sin(math.radians(lat))
    x, y = lon / 360 + 0.5, 0.5 - 0.25 * math.log((1 + s) / (1 - s)) / math.pi
    x, y = (max(0, min(2**zoom - 1, math.floor((v + 1e-14) * 2**zoom))) for v in (x, y))
    return "".join(str((x >> i & 1) + 2 * (y >> i & 1)) for i in range(zoom - 1, -1, -1))


def _geohash(lat, lon, precision):
    """Plain Python twin: halve the intervals."""
    box = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}
    value = {0: lon, 1: lat}
    bits = []
    for i in range(5 * precision):
        lo, hi = box[i % 2]
        mid = (lo + hi) / 2
        bits.append(int(value[i % 2] >= mid))
        box[i % 2] = [mid, hi] if bits[-1] else [lo, mid]
    digits = [int("".join(map(str, bits[i : i + 5])), 2) for i in range(0, len(bits), 5)]
    return "".join(cells.GEOHASH_ALPHABET[d] for d in digits)


def test_known_keys(spark):
    df = spark.createDataFrame([(13.7563, 100.5018), (0.0, 0.0), (57.64911, 10.40744), (42.6, -5.6)], "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    rows = df.select(
        cells.tile_key(lat, lon, 16).alias("t16"), cells.tile_key(lat, lon, 3).alias("t3"),
        cells.geohash(lat, lon, 8).alias("g8"), cells.geohash(lat, lon, 5).alias("g5"),
    ).collect()
    assert rows[0].t16 == "1322033101132333"
    assert rows[1].t3 == "300"
    assert rows[2].g8 == "u4pruydq"
    assert rows[3].g5 == "ezs42"


def test_random_points_all_precisions(spark):
    rng = random.Random(7)
    points = [(rng.uniform(-85, 85), rng.uniform(-180, 179.99)) for _ in range(300)]
    points += [(0.0, 0.0), (-45.0, 90.0), (84.9, -180.0), (-90.0, 10.0)]
    df = spark.createDataFrame(points, "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    tiles = [cells.tile_key(lat, lon, z).alias(f"t{z}") for z in (1, 9, 18, 19, 24)]
    hashes = [cells.geohash(lat, lon, p).alias(f"g{p}") for p in range(1, 13)]
    for row in df.select("lat", "lon", *tiles, *hashes).collect():
        if row.lat > -90:
            for z in (1, 9, 18, 19, 24):
                assert row[f"t{z}"] == _tile(row.lat, row.lon, z)
        for p in range(1, 13):
            assert row[f"g{p}"] == _geohash(row.lat, row.lon, p)


def test_missing_and_odd_coordinates(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(None, 1.0), (1.0, None), (nan, 1.0), (1.0, nan), (90.0, 0.0), (89.9999999999999, 0.0), (10.0, 190.0)],
        "lat double, lon double",
    )
    lat, lon = F.col("lat"), F.col("lon")
    rows = df.select(cells.tile_key(lat, lon, 4).alias("t"), cells.geohash(lat, lon, 5).alias("g")).collect()
    assert [r.t for r in rows[:5]] == [None] * 5
    assert [r.g for r in rows[:5]] == [None] * 5
    assert rows[5].t == "1000"  # northern edge row
    assert rows[6].t[0] == "1" and rows[6].g == _geohash(10.0, -170.0, 5)


def test_key_to_position_and_back(spark):
    keys = ["1322033101132333", "300", "0", "3333333333333333333333"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    b = cells.tile_centroid(F.col("k"))
    for row in df.select("k", b["lat"].alias("lat"), b["lon"].alias("lon")).collect():
        assert _tile(row.lat, row.lon, len(row.k)) == row.k


def test_outline(spark):
    df = spark.createDataFrame([("300",), (None,), ("",), ("12a",), ("1322033101132333",)], "k string")
    rows = [r[0] for r in df.select(cells.tile_outline(F.col("k"), decimals=4)).collect()]
    assert rows[0] == "POLYGON ((0 -40.9799, 0 0, 45 0, 45 -40.9799, 0 -40.9799))"
    assert rows[1:4] == [None, None, None]
    assert rows[4].startswith("POLYGON ((100.4974 13.7527, 100.4974 13.7581,")


def test_cells_run_in_codegen(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("lat"), F.col("id").cast("double").alias("lon"))
    out = df.select(cells.tile_key(F.col("lat"), F.col("lon"), 16), cells.geohash(F.col("lat"), F.col("lon"), 6))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "*(1) Project" in plan and "Python" not in plan


def test_ping_features_from_text(spark):
    df = spark.createDataFrame([("13.7563", "100.5018"), ("x", "1"), (None, "1")], "lat string, lon string")
    rows = features.ping_cells(df).collect()
    assert (rows[0].gh6, rows[0].gh5, rows[0].tile) == ("w4rqqb", "w4rqq", "1322033101132333")
    assert rows[1].gh6 is None and rows[2].tile is None


def test_category_matrix_and_roll_up(spark):
    df = spark.createDataFrame(
        [("aa1", "x"), ("aa1", "x"), ("aa1", "y"), ("aa2", "y"), ("bb1", None)], "cell string, kind string"
    )
    fine = features.category_counts(df, "cell", "kind")
    assert fine.columns == ["cell", "null", "x", "y"]
    assert sorted(map(tuple, fine.collect())) == [("aa1", 0, 2, 1), ("aa2", 0, 0, 1), ("bb1", 1, 0, 0)]
    coarse = features.roll_up_cells(fine, "cell", 2, "parent")
    assert sorted(map(tuple, coarse.collect())) == [("aa", 0, 2, 2), ("bb", 1, 0, 0)]
    fixed = features.category_counts(df, "cell", "kind", ["x", "z"])
    assert sorted(map(tuple, fixed.collect())) == [("aa1", 2, 0), ("aa2", 0, 0), ("bb1", 0, 0)]


def test_category_rows_have_no_limit_of_columns(spark):
    places = spark.range(30_000).selectExpr("'c' AS cell", "IF(id % 3 = 0, NULL, cast(id AS string)) AS category")
    out = features.category_rows(places, "cell", "category")
    assert out.count() == 20_001 and out.where("category = 'null'").first()["rows"] == 10_000


def test_sparse_matrix_of_many_categories(spark):
    """More categories than any table has columns, missing ones among them; a cell with most of the rows."""
    df = spark.range(30_000).selectExpr("IF(id % 5 = 0, concat('c', id % 70), 'hot') AS here", "IF(id % 7 = 0, NULL, concat('k', id % 12001)) AS kind")
    dictionary = features.category_dictionary(df, "kind")
    names = {r["index"]: r.kind for r in dictionary.collect()}
    assert len(names) > 10_000 and sorted(names.values()) == [names[i] for i in range(len(names))]
    rows = features.category_matrix(df, [F.col("here"), F.lit("all")], "kind", dictionary).collect()
    got = {(r.cell, names[i]): n for r in rows for i, n in zip(r.indices, r.counts)}
    assert all(r.indices == sorted(r.indices) for r in rows)
    want = {}
    for i in range(30_000):
        kind = "null" if i % 7 == 0 else f"k{i % 12001}"
        for cell in (f"c{i % 70}" if i % 5 == 0 else "hot", "all"):
            want[cell, kind] = want.get((cell, kind), 0) + 1
    assert got == want
    assert features.category_matrix(df.where("false"), [F.col("here")], "kind", dictionary).count() == 0
