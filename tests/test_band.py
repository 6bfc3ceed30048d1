import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tileframe.operators import band

SCHEMA = "tile string, adm1 string, adm2 string, adm3 string, floor_area double, pop double"
LEVELS = (("adm1", "adm2", "adm3"), ("adm1", "adm2"), ("adm1",))


def brute(rows):
    """The cascade by comparing all rows with all rows."""
    donors = [r for r in rows if r[5] is not None]
    out = {}
    for t in rows:
        if t[5] is not None:
            out[t[0]] = (t[5], 0)
            continue
        for stage, names in enumerate(((1, 2, 3), (1, 2), (1,)), start=1):
            near = [
                d[5] for d in donors
                if all(d[i] is not None and d[i] == t[i] for i in names)
                and t[4] is not None and d[4] is not None and t[4] * 0.8 <= d[4] <= t[4] * 1.2
            ]
            if near:
                out[t[0]] = (sum(near) / len(near), stage)
                break
    return out


def random_rows(n, seed=2):
    """A third of the tiles have one and the same area; some areas are zero, some names missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        adm = [rng.choice("AB"), rng.choice("cd"), rng.choice("efgh")]
        if rng.random() < 0.03:
            adm[2] = None
        area = rng.choice([100.0, rng.uniform(1, 1000), rng.choice([0.0, rng.uniform(1, 1e6)])])
        rows.append((f"t{i}", *adm, area, rng.choice([None, rng.uniform(0, 500), rng.uniform(0, 500)])))
    return rows


def test_cascade_equals_brute_force(spark):
    rows = random_rows(900)
    tiles = spark.createDataFrame(rows, SCHEMA)
    got = {r.tile: (r["pop"], r.stage) for r in band.impute_cascade(tiles, stage="stage").collect()}
    want = brute(rows)
    assert got.keys() == want.keys() and len({s for _, s in want.values()}) == 4
    for tile, (pop, stage) in want.items():
        assert got[tile][1] == stage and got[tile][0] == pytest.approx(pop, rel=1e-9)


def test_each_stage(spark):
    rows = [
        ("near", "A", "c", "e", 100.0, 10.0), ("edge", "A", "c", "e", 120.0, 30.0), ("out", "A", "c", "e", 121.0, 999.0),
        ("t1", "A", "c", "e", 100.0, None), ("t2", "A", "c", "f", 100.0, None), ("t3", "A", "d", "g", 100.0, None),
        ("t4", "B", "c", "e", 100.0, None), ("zero", "A", "c", "e", 0.0, 4.0), ("t5", "A", "c", "e", 0.0, None),
        ("t6", "A", "c", "e", None, None),
    ]
    tiles = spark.createDataFrame(rows, SCHEMA)
    done = band.impute_cascade(tiles, stage="stage")
    got = {r.tile: (r["pop"], r.stage) for r in done.collect() if r.tile.startswith("t")}
    assert got == {"t1": (20.0, 1), "t2": (20.0, 2), "t3": (20.0, 3), "t5": (4.0, 1)}
    assert sorted(r.tile for r in band.unresolved_tiles(tiles, done).collect()) == ["t4", "t6"]
    assert band.impute_cascade(tiles).columns == ["tile", "floor_area", "adm3", "adm2", "adm1", "pop"]


def test_cascade_forms_no_pairs(spark):
    """All tiles in one group and one band: pairs would be 4 million rows; sorted rows are a few thousand."""
    tiles = spark.range(6000).selectExpr(
        "concat('t', id) AS tile", "'A' AS adm1", "'c' AS adm2", "'e' AS adm3",
        "100D + id / 1000 AS floor_area", "IF(id % 3 = 0, NULL, CAST(id AS DOUBLE)) AS pop",
    )
    done = band.impute_cascade(tiles)
    assert done.count() == 6000
    assert "CartesianProduct" not in plan_of(done)
    filled = done.filter("tile = 't3000'").first()["pop"]
    low, high = 103.0 * 0.8, 103.0 * 1.2
    near = [i for i in range(6000) if i % 3 and low <= 100 + i / 1000 <= high]
    assert filled == pytest.approx(sum(near) / len(near))


def test_band_join_equals_brute_force(spark):
    rows = random_rows(400, seed=9)
    tiles = spark.createDataFrame(rows, SCHEMA)
    targets = tiles.filter("pop IS NULL").select("tile", "adm1", "floor_area")
    donors = tiles.filter("pop IS NOT NULL")
    joined = band.band_join(targets, donors, ["adm1"], "floor_area", "pop")
    want = []
    for t in (r for r in rows if r[5] is None):
        near = [(t[0], d[4], d[5]) for d in rows if d[5] is not None and d[1] == t[1] and t[4] * 0.8 <= d[4] <= t[4] * 1.2]
        want += near or [(t[0], None, None)]
    got = [(r.tile, r.neighbour_floor_area, r.neighbour_pop) for r in joined.collect()]
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    plan = plan_of(joined)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_band_averages_without_donors(spark):
    tiles = spark.createDataFrame([("t", "A", "c", "e", 1.0, None)], SCHEMA)
    assert band.impute_cascade(tiles).count() == 0
    assert band.band_averages(tiles.select("tile", "floor_area", "adm1"), tiles, [("adm1",)], "floor_area", "pop").filter(
        F.col("_avg_0").isNotNull()
    ).count() == 0


@pytest.mark.parametrize("unit", [1e-11, 1.0, 1e19])
def test_measures_of_any_size(spark, unit):
    rows = [("a", "A", "c", "e", 10.0, 3 * unit), ("b", "A", "c", "e", 11.0, 5 * unit), ("t", "A", "c", "e", 10.5, None)]
    out = band.impute_cascade(spark.createDataFrame(rows, SCHEMA)).where("tile = 't'").first()
    assert out.pop == pytest.approx(4 * unit, rel=1e-12)


def test_totals_without_room_are_refused(spark):
    rows = [("a", "A", "c", "e", 10.0, 1e37), ("t", "A", "c", "e", 10.5, None)]
    with pytest.raises(ValueError, match="digits"):
        band.impute_cascade(spark.createDataFrame(rows, SCHEMA))


def test_band_join_of_repeated_rows_and_missing_names(spark):
    rows = [("t", "A", 100.0, None), ("t", "A", 100.0, None), ("u", None, 100.0, None), ("v", "A", None, None), ("w", "A", -1.0, None),
            ("x", "A", 0.0, None), ("d", "A", 100.0, 1.0), ("d", "A", 100.0, 1.0), ("e", "A", 0.0, 2.0), ("f", None, 100.0, 3.0)]
    tiles = spark.createDataFrame(rows, "tile string, adm1 string, floor_area double, pop double")
    got = band.band_join(tiles.filter("pop IS NULL").drop("pop"), tiles.filter("pop IS NOT NULL"), ["adm1"], "floor_area", "pop")
    assert sorted((r.tile, r.neighbour_pop) for r in got.collect() if r.neighbour_pop) == [("t", 1.0)] * 4 + [("x", 2.0)]
    assert sorted(r.tile for r in got.collect() if r.neighbour_pop is None) == ["u", "v", "w"]


def test_band_join_of_one_hot_group(spark, monkeypatch):
    """All rows in one group, two thirds of them with one value: blocks stay bounded, and no pair is lost."""
    monkeypatch.setattr(band, "BLOCK", 64)
    tiles = spark.range(1500).selectExpr(
        "concat('t', id) AS tile", "'A' AS adm1", "IF(id % 3 = 0, 100D + id, 500D) AS floor_area", "IF(id % 2 = 0, NULL, CAST(id AS DOUBLE)) AS pop"
    )
    targets, donors = tiles.filter("pop IS NULL").drop("pop"), tiles.filter("pop IS NOT NULL")
    blocks = band.band_blocks(targets, donors, ["adm1"], "floor_area", "pop")
    asked = blocks.targets.groupBy("_block", "_portion").count().agg(F.max("count")).first()[0]
    offered = blocks.donors.groupBy("_d_block", "_d_portion").count().agg(F.max("count")).first()[0]
    assert asked <= 2 * 64 and offered <= 64
    area = [100.0 + i if i % 3 == 0 else 500.0 for i in range(1500)]
    want = sum(area[t] * 0.8 <= area[d] <= area[t] * 1.2 for t in range(0, 1500, 2) for d in range(1, 1500, 2))
    joined = band.band_join(targets, donors, ["adm1"], "floor_area", "pop")
    assert joined.filter("neighbour_pop IS NOT NULL").count() == want
