import pytest
from conftest import plan_of

from tileframe.functions.geometry import RINGS_TYPE
from tileframe.operators import features
from tileframe.operators.cover import cover_polygons
from tileframe.plans import pings as jobs


def box(w, s, e, n):
    return [[{"x": x, "y": y} for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s))]]


@pytest.fixture(scope="module")
def areas(spark):
    return spark.createDataFrame([("A", "s1", box(0.0, 0.0, 1.0, 1.0)), ("B", "s2", box(1.0, 0.0, 2.0, 1.0))], f"adm1 string, adm3 string, rings {RINGS_TYPE}")


@pytest.fixture(scope="module")
def pings(spark):
    return spark.sql("""SELECT * FROM VALUES
        (1, TIMESTAMP'2024-01-01 16:59:59', '0.5', '0.5'), (2, TIMESTAMP'2024-01-01 17:00:00', '0.5', '1.0'),
        (3, TIMESTAMP'2024-01-01 00:00:00', NULL, '0.5'), (4, TIMESTAMP'2024-01-01 00:00:00', 'x', '0.5'),
        (5, TIMESTAMP'2024-01-02 00:00:00', '0.5', '9') AS t(id, ts, lat, lon)""")


def test_tags_and_day(areas, pings):
    tagged = jobs.tag_pings(pings, areas, ["adm1", "adm3"], zone="Asia/Bangkok")
    got = {(r.id, str(r.event_date), r.adm1) for r in tagged.collect()}
    assert got == {(1, "2024-01-01", "A"), (2, "2024-01-02", "A"), (2, "2024-01-02", "B")}
    strict = jobs.tag_pings(pings, cover_polygons(areas, ["adm1", "adm3"]), ["adm3"], predicate="contains")
    assert [(r.id, str(r.event_date), r.adm3) for r in strict.collect()] == [(1, "2024-01-01", "s1")]


def test_place_visits_stay_in_their_province(spark, areas, pings):
    tagged = jobs.tag_pings(pings, areas, ["adm1"])
    feet = spark.createDataFrame([(7, "A", "pl", box(0.4, 0.4, 1.0, 0.6)), (8, "C", None, box(0.0, 0.0, 2.0, 2.0))], f"building_id int, adm1 string, place_id string, rings {RINGS_TYPE}")
    visits = jobs.place_visits(tagged, feet)
    assert {(r.id, r.adm1, r.building_id, r.place_id) for r in visits.collect()} == {(1, "A", 7, "pl"), (2, "A", 7, "pl")}


def test_building_visits(spark):
    # 17:00 UTC is midnight in Bangkok; the third ping lies on the building's edge.
    rows = [(1, 1704128399000, 0.5, 0.5, "text"), (2, 1704128400000, 0.5, 0.5, "text"), (3, 1704128400000, 0.4, 0.5, "t")]
    pings = spark.createDataFrame(rows, "id int, ts_ms long, lon double, lat double, consent string")
    feet = spark.createDataFrame([(7, box(0.4, 0.4, 1.0, 0.6))], f"building_id int, rings {RINGS_TYPE}")
    visits = jobs.building_visits(pings, feet, zone="Asia/Bangkok")
    assert "consent" not in visits.columns
    assert {(r.id, str(r.event_date)) for r in visits.collect()} == {(1, "2024-01-01"), (2, "2024-01-02")}
    busiest = jobs.busiest_day(visits.unionByName(visits.filter("id = 2"))).first()
    assert (str(busiest.event_date), busiest["rows"]) == ("2024-01-02", 2)


def test_providers_and_labels(spark):
    pings = spark.createDataFrame([("d", "x"), ("d", "x"), ("e", None), ("f", "y")], "device string, isp string")
    assert [tuple(r) for r in features.pings_of_providers(pings, ["x"]).collect()] == [("d", "x")]
    places = spark.createDataFrame([(1, 2.0), (2, None), (3, 1.0)], "place_id int, lat double")
    catalog = spark.createDataFrame([(1, ["a", "b"]), (2, ["c"])], "place_id int, labels array<string>")
    got = features.attach_labels(places, catalog, text="text")
    assert [(r.place_id, r.labels, r.text) for r in got.collect()] == [(1, ["a", "b"], "a, b")]


def test_busy_day_in_batches(spark, tmp_path):
    """The busiest day only, equal batches over all its pings, no sort of the day in one task, other folders stay."""
    feet = spark.createDataFrame([(7, box(0.4, 0.4, 1.0, 0.6))], f"building_id int, rings {RINGS_TYPE}")
    pings = spark.range(200).selectExpr(
        "id AS event_id", "1704067200000 + IF(id % 4 = 0, 86400000, 0) + (id * 7919 % 200) * 1000 AS ts_ms",
        "IF(id % 10 = 1, NULL, 0.5D) AS lon", "0.5D AS lat", "'c' AS consent",
    )
    visits = jobs.busy_day_visits(pings, feet, batches=4, zone="UTC")
    rows = visits.collect()
    day = sorted((1704067200000 + (i * 7919 % 200) * 1000, i) for i in range(200) if i % 4)
    parts = [p for p, size in ((1, 38), (2, 38), (3, 37), (4, 37)) for _ in range(size)]
    want = {i: p for p, (_, i) in zip(parts, day, strict=True)}
    assert {r.event_id: r.part for r in rows} == {i: p for i, p in want.items() if i % 10 != 1}
    assert {str(r.event_date) for r in rows} == {"2024-01-01"} and "consent" not in visits.columns
    # All that comes together in one task is one line per sorted run.
    lines = plan_of(visits).splitlines()
    single = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert all("keys=[_run" in "".join(lines[i + 1 : i + 3]) for i in single)
    path = str(tmp_path / "out")
    for _ in range(2):  # a second run replaces the same folders
        jobs.write_busy_day(visits.select("event_id", "event_date", "part"), path)
    back = spark.read.parquet(path)
    assert {(r.event_id, str(r.date), r.part) for r in back.collect()} == {(r.event_id, "2024-01-01", r.part) for r in rows}
    assert back.count() == len(rows)


def test_day_is_written_as_text_before_the_join(spark):
    shapes = spark.createDataFrame([(i, box(0.0, 0.0, 9.0, 9.0)) for i in range(3)], f"building_id long, rings {RINGS_TYPE}")
    seen = spark.createDataFrame(
        [(1, 0, 4.0, 4.0, "c"), (2, 61_200_000, 5.0, 5.0, "c"), (3, None, 6.0, 6.0, "c")],
        "event_id long, ts_ms long, lon double, lat double, consent string",
    )
    dated = jobs.building_visits(seen, shapes, zone="Asia/Bangkok")
    visits = jobs.building_visits(seen, shapes, zone="Asia/Bangkok", day_type="string").select("event_id", "event_date", "building_id")
    want = dated.selectExpr("event_id", "CAST(event_date AS STRING) AS event_date", "building_id")
    assert sorted(visits.collect(), key=str) == sorted(want.collect(), key=str)
    assert {(r[0], r[1]) for r in visits.collect()} == {(1, "1970-01-01"), (2, "1970-01-02"), (3, None)}
    plan = visits._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in plan.split("Join")[0] and "as string" in plan
