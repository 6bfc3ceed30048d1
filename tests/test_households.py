import pytest
from pyspark.sql import functions as F

from tileframe.functions import keys
from tileframe.operators import households, qc, tables
from tileframe.plans import households as household_jobs
from tileframe.plans.households import estimate_households


@pytest.fixture(scope="module")
def tiles(spark):
    return spark.createDataFrame(
        [("t1", "North East", "d1", 100.0, 4.0), ("t2", "North East", "d1", 300.0, 2.0), ("t3", "North East", "d2", 50.0, 0.0), ("t4", "South", "d3", 10.0, 2.0)],
        "tile string, adm1 string, adm2 string, adjusted_pop double, pop_to_hh double",
    )


@pytest.fixture(scope="module")
def truth(spark):
    return spark.createDataFrame(
        [("North East", "d1", 800.0), ("North East", "d2", 500.0), ("Elsewhere", "d9", 1.0)], "adm1 string, adm2 string, population double"
    )


def test_names_and_numbers(spark):
    df = spark.createDataFrame([("Phra Nakhon-Si (A) ", "1,000", 0)], "name string, text string, zero int")
    row = df.select(
        keys.snake_name(F.col("name")).alias("snake"), keys.squash_name(F.col("name")).alias("squash"),
        keys.to_number(F.col("text")).alias("number"), keys.ratio(F.lit(1), F.col("zero")).alias("ratio"),
        keys.percent_diff(F.lit(110), F.lit(100)).alias("pct"), keys.unguard_key(keys.guard_key(F.col("text"))).alias("key"),
    ).first()
    assert tuple(row) == ("phra_nakhon_si_a_", "phranakhon-si(a)", None, None, 10.0, "1,000")


def test_event_day_does_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 18:30:00' AS wall, timestamp_millis(1704133800000) AS instant")
        days = df.select(
            keys.event_day(df, "wall", "Asia/Bangkok").cast("string"), keys.event_day(df, "instant", "Asia/Bangkok").cast("string"),
            keys.event_day(df, "instant").cast("string"),
        ).first()
        assert tuple(days) == ("2024-01-02", "2024-01-02", "2024-01-01")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_control_ratio_and_scaling(spark, tiles):
    control = spark.createDataFrame([("NorthEast", 900.0), ("south", 0.0), ("west", 5.0)], "name string, population double")
    ratios = households.control_ratio(tiles, control, pop="adjusted_pop")
    assert {tuple(r) for r in ratios.collect()} == {("northeast", 2.0), ("south", 0.0)}
    scaled = households.scale_to_control(tiles, tiles, ratios, pop="adjusted_pop", scaled="scaled")
    assert scaled.groupBy("adm1").agg(F.sum("scaled")).collect()[0][1] in (900.0, 0.0)
    assert scaled.agg(F.sum("scaled")).first()[0] == 900.0


def test_multipliers_extremes_and_reallocation(spark, tiles, truth):
    multipliers = households.district_multipliers(tiles, truth)
    assert {(r.adm2, r.multiplier) for r in multipliers.collect()} == {("d1", 2.0), ("d2", 10.0)}
    usual, extreme = households.split_extremes(multipliers)
    assert [r.adm2 for r in usual.collect()] == ["d1"] and [r.adm2 for r in extreme.collect()] == ["d2"]
    scaled = {r.tile: (r.truth_adjusted_pop, r.hh) for r in households.apply_multipliers(tiles, multipliers).collect()}
    assert scaled == {"t1": (200.0, 50.0), "t2": (600.0, 300.0), "t3": (500.0, None)}

    buildings = spark.createDataFrame([("t1",)] * 3 + [("t2",)], "tile string")
    all_districts = multipliers
    shares = {}
    for kind in ("buildings", "rows"):
        out = households.reallocate_by_buildings(tiles, all_districts, buildings, denominator=kind)
        shares[kind] = {r.tile: r.truth_adjusted_pop for r in out.collect()}
    assert shares["buildings"] == {"t1": 600.0, "t2": 200.0}  # the district total of 800 is kept
    assert shares["rows"] == {"t1": 1200.0, "t2": 400.0}
    with pytest.raises(ValueError):
        households.reallocate_by_buildings(tiles, all_districts, buildings, denominator="tiles")


def test_correction_meets_control(spark):
    estimates = spark.createDataFrame([("t1", "a", 10.0, 30.0), ("t2", "a", 30.0, 60.0), ("t3", "a", 0.0, 5.0), ("t4", "b", 7.0, 7.0)], "tile string, adm1 string, hh double, adjusted_pop double")
    control = spark.createDataFrame([("A", 80.0)], "name string, households double")
    rows = {r.tile: r for r in households.household_correction(estimates, control).collect()}
    assert set(rows) == {"t1", "t2", "t3"}
    assert rows["t1"].hh_corrected == 20.0 and rows["t1"].pop_to_hh_corrected == 1.5
    assert sum(r.hh_corrected for r in rows.values()) == 80.0 and rows["t3"].pop_to_hh_corrected is None


def test_combine_sources(spark):
    a = spark.createDataFrame([("1", "North East", "D-1", "S (x)", 1.2), ("2", "North East", "D-1", "S (x)", -3.0)], "tile string, adm1 string, adm2 string, adm3 string, hh double")
    b = spark.createDataFrame([("1", "north_east", "d_1", "s_x_", 2.0), ("3", "north_east", "d_1", "s_x_", 5.0), ("4", "n", "d", "s", None)], a.schema)
    overrides = spark.createDataFrame([("3", 103)], "tile string, hh int")
    got = households.combine_sources(a, b, overrides=overrides)
    assert {tuple(r) for r in got.collect()} == {("1", "north_east", "d_1", "s_x_", 4), ("3", "north_east", "d_1", "s_x_", 103)}
    assert dict(got.dtypes)["hh"] == "int"


def test_table_helpers(spark, tiles):
    with pytest.raises(ValueError):
        tables.same_columns(tiles, tiles.drop("adm1"))
    tables.same_columns(tiles, tiles)
    kept = tables.without_groups(tiles, "adm1", ["South"])
    assert kept.count() == 3 and tables.only_groups(tiles, "adm1", ["South"]).count() == 1
    counted = tables.with_group_totals(tiles, ["adm1"], [F.count(F.lit(1)).alias("n"), F.sum("adjusted_pop").alias("s")])
    assert {(r.tile, r.n, r.s) for r in counted.collect()} == {("t1", 3, 450.0), ("t2", 3, 450.0), ("t3", 3, 450.0), ("t4", 1, 10.0)}
    changed = tables.override_values(tiles, spark.createDataFrame([("t1", None), ("t2", 1.0)], "tile string, adjusted_pop double"), "tile", "adjusted_pop")
    assert {r.tile: r.adjusted_pop for r in changed.collect()} == {"t1": None, "t2": 1.0, "t3": 50.0, "t4": 10.0}


def test_estimate_households_end_to_end(spark):
    n = 60
    population = spark.range(n).selectExpr("concat('t', id) AS tile", "CAST(10 + id AS DOUBLE) AS pop")
    tile_map = spark.range(n).selectExpr("concat('t', id) AS tile", "IF(id % 3 = 0, 'Far West', 'East') AS adm1")
    metric = spark.range(n).selectExpr("concat('t', id) AS tile", "CAST(id DIV 4 AS DOUBLE) AS floor_area")
    control = spark.createDataFrame([("FarWest", 1000.0, 3.0), ("EAST", 4000.0, 2.5)], "name string, population double, pop_to_hh double")
    for kind in ("gaussian", "uniform"):
        out = estimate_households(population, tile_map, metric, control, kind=kind)
        rows = out.collect()
        assert len(rows) == n
        for name, total, mean in (("farwest", 1000.0, 3.0), ("east", 4000.0, 2.5)):
            mine = sorted((r for r in rows if r.adm1 == name), key=lambda r: (-r.floor_area, r.tile))
            assert sum(r.adjusted_pop for r in mine) == pytest.approx(total)
            draws = [r.pop_to_hh for r in mine]
            assert draws == sorted(draws) and mean - 0.87 <= draws[0] <= draws[-1] <= mean + 0.87
            assert all(r.hh == pytest.approx(r.adjusted_pop / r.pop_to_hh, abs=0.5) for r in mine)


def test_quality_checks(spark, tiles):
    control = spark.createDataFrame([("northeast", 100.0), ("South", 0.0)], "name string, households double")
    est = tiles.withColumn("hh", F.col("adjusted_pop") / 10)
    diff = {r.adm1: r.pct_diff for r in qc.control_difference(est, control).collect()}
    assert diff == {"northeast": -55.0, "south": None}
    assert {r.pct_diff for r in qc.control_difference(est, control, absolute=True).collect()} == {55.0, None}

    areas = spark.createDataFrame([("a", 500.0, 10.0), ("b", 501.0, 1.0), ("c", 400.0, 1.0), ("d", 90.0, 1.0), ("e", 1.0, 0.0)], "tile string, floor_area double, hh double")
    flags = {r.tile: (r.area_per_hh, r.outlier, r.too_low, r.too_high) for r in qc.area_per_household(areas).collect()}
    assert flags == {
        "a": (50.0, True, True, False), "b": (501.0, True, False, True), "c": (400.0, False, False, True),
        "d": (90.0, False, True, False), "e": (None, None, None, None),
    }

    buildings = spark.createDataFrame([(1, "a", 2), (2, "a", 3), (3, "b", 1), (4, "c", 1), (5, "d", 0)], "building_id int, tile string, floors int")
    excess = qc.floor_excess(buildings, areas)
    assert {(r.tile, r.excess_pct) for r in excess.collect()} == {("a", 100.0)}
    assert [r.building_id for r in qc.worst_buildings(buildings, excess, rows=1).collect()] == [1]
    assert [r.tile for r in qc.worst_floor_excess(excess).collect()] == ["a"]


def test_totals_of_a_hot_group_without_broadcasts_or_adaptive_plans(spark):
    """A third of all rows in one group: no task of the join reads more than twice what the middle one does."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(60_000).selectExpr("concat('t', id) AS tile", "IF(id % 3 = 0, 'hot', concat('g', id % 5000)) AS adm1", "id AS pop")
        rows = rows.unionByName(spark.sql("SELECT 'x' AS tile, CAST(NULL AS STRING) AS adm1, 1L AS pop"))
        out = tables.with_group_totals(rows, ["adm1"], [F.sum("pop").alias("s"), F.count(F.lit(1)).alias("n")])
        tasks = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert len(tasks) == 8 and tasks[-1] <= 2 * tasks[4]
        sums = {r.adm1: (r.s, r.n, r.rows) for r in out.groupBy("adm1", "s", "n").agg(F.count(F.lit(1)).alias("rows")).collect()}
        want = rows.where("adm1 IS NOT NULL").groupBy("adm1").agg(F.sum("pop").alias("s"), F.count(F.lit(1)).alias("n")).collect()
        assert sums == {r.adm1: (r.s, r.n, r.n) for r in want}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_routed_districts_agree_with_the_separate_steps(spark):
    tiles = spark.range(300).selectExpr(
        "concat('t', id) AS tile", "'p' AS adm1", "concat('d', IF(id % 3 = 0, 0, id % 7)) AS adm2", "CAST(id % 11 AS DOUBLE) AS adjusted_pop",
        "2D + id % 3 AS pop_to_hh",
    )
    tiles = tiles.unionByName(spark.sql("SELECT 'z' AS tile, 'p' AS adm1, 'empty' AS adm2, 0D AS adjusted_pop, 2D AS pop_to_hh"))
    truth = spark.createDataFrame([("p", f"d{i}", 10.0**i) for i in range(6)] + [("p", "empty", 5.0), ("q", "d0", 1.0)], "adm1 string, adm2 string, population double")
    buildings = spark.range(500).selectExpr("concat('t', id * id % 290) AS tile")
    multipliers = households.district_multipliers(tiles, truth)
    usual, extreme = households.split_extremes(multipliers.filter("multiplier IS NOT NULL"), 2.0)
    for kind in ("buildings", "rows"):
        routed = households.route_districts(tiles, truth, buildings, 2.0, denominator=kind)
        columns = ["tile", "adm2", "truth_adjusted_pop", "hh"]
        got = {r.tile: (r.method, r.truth_adjusted_pop, r.hh) for r in routed.collect()}
        want = {r.tile: ("multiplier", r.truth_adjusted_pop, r.hh) for r in households.apply_multipliers(tiles, usual).select(columns).collect()}
        spread = households.reallocate_by_buildings(tiles, extreme, buildings, denominator=kind).select(columns)
        want |= {r.tile: ("buildings", r.truth_adjusted_pop, r.hh) for r in spread.collect()}
        assert got.keys() == want.keys() and {m for m, *_ in want.values()} == {"multiplier", "buildings"}
        assert all(got[t][0] == want[t][0] and got[t][1:] == pytest.approx(want[t][1:]) for t in want)
    kept = households.route_districts(tiles, truth, buildings).groupBy("adm2").agg(F.sum("truth_adjusted_pop").alias("s"))
    assert {r.adm2: r.s for r in kept.collect()} == pytest.approx({f"d{i}": 10.0**i for i in range(6)})


def test_district_job_lists_where_households_come_from(spark):
    tiles = spark.createDataFrame([("a", "P q", "d1", "s", 10.0, 2.0), ("b", "P q", "d2", "s", 1.0, 2.0)], "tile string, adm1 string, adm2 string, adm3 string, adjusted_pop double, pop_to_hh double")
    truth = spark.createDataFrame([("P q", "d1", 11.0), ("P q", "d2", 100.0)], "adm1 string, adm2 string, population double")
    buildings = spark.createDataFrame([("b",), ("b",), ("a",)], "tile string")
    other = spark.createDataFrame([("a", "p-Q", "D1", "s", 1.2), ("c", "P q", "d1", "s", 3.0), ("n", "P q", "d1", "s", 0.0)], "tile string, adm1 string, adm2 string, adm3 string, hh double")
    overrides = spark.createDataFrame([("c", 8.5)], "tile string, hh double")
    out = household_jobs.district_job(tiles, truth, buildings, other, overrides=overrides)
    assert {r.tile: (r.adm1, r.hh, r.method) for r in out.collect()} == {
        "a": ("p_q", 7, "multiplier,other"), "b": ("p_q", 50, "buildings"), "c": ("p_q", 9, "other"),
    }


def test_recheck_after_correction(spark):
    estimates = spark.createDataFrame([("a", "p", "d", 30.0, 90.0), ("b", "p", "e", 30.0, 90.0), ("c", "p", "e", 1.0, 3.0)], "tile string, adm1 string, adm2 string, hh double, adjusted_pop double")
    control = spark.createDataFrame([("P", 100.0)], "name string, households double")
    corrected, check = household_jobs.corrected_households(estimates, control)
    assert sorted(r.hh_corrected for r in corrected.collect()) == [2.0, 49.0, 49.0]
    assert [(r.est_hh, r.control_hh, r.pct_diff) for r in check.collect()] == [(100.0, 100.0, 0.0)]
