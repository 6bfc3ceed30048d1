import random
from decimal import Decimal

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from tileframe.operators import ordered, rank


@pytest.fixture(scope="module")
def skewed(spark):
    """A hot group with two thirds of the rows, mostly ties, and a NULL group."""
    rng = random.Random(1)
    rows = [(i, "hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([1.0, 1.0, 1.0, 2.0, rng.random(), None])) for i in range(6000)]
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(7).cache()


def test_row_numbers_equal_window(spark, skewed):
    got = ordered.row_numbers(skewed, ["g"], [F.desc("v"), "id"], "n")
    skewed.createOrReplaceTempView("skewed")
    want = spark.sql("SELECT *, row_number() OVER (PARTITION BY g ORDER BY v DESC, id) AS n FROM skewed")
    assert got.count() == 6000 and got.select(want.columns).exceptAll(want.withColumn("n", F.col("n").cast("long"))).count() == 0


def test_hot_group_spans_runs(skewed):
    runs = ordered.sorted_runs(skewed, ["g", "v", "id"])
    per_run = runs.filter("g = 'hot'").groupBy(ordered.RUN).count().collect()
    assert len(per_run) > 3 and max(r["count"] for r in per_run) < 3000


@pytest.mark.parametrize("buckets", [1, 12, 7000])
def test_global_ntile(spark, skewed, buckets):
    skewed.createOrReplaceTempView("skewed")
    want = spark.sql(f"SELECT id, ntile({buckets}) OVER (ORDER BY v, id) AS bucket FROM skewed")
    got = ordered.global_ntile(skewed, ["v", "id"], buckets).select("id", "bucket")
    assert got.count() == 6000 and got.exceptAll(want).count() == 0


def test_ntile_gathers_only_run_sizes_in_one_task(skewed):
    lines = plan_of(ordered.global_ntile(skewed, ["v", "id"], 12)).splitlines()
    for at, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[_run" in lines[at + 1]
        assert "Window" not in line or "_n#" in line


def test_running_sums(spark, skewed):
    df = skewed.withColumn("m", F.expr("CAST(id / 1000 AS DECIMAL(28,10))"))
    got = ordered.running_sums(df, ["g"], ["v", "id"], {"s": "m", "c": "id"})
    df.createOrReplaceTempView("summed")
    window = "OVER (PARTITION BY g ORDER BY v, id ROWS UNBOUNDED PRECEDING)"
    want = spark.sql(f"SELECT id, CAST(sum(m) {window} AS DECIMAL(38,10)) AS s, sum(id) {window} AS c FROM summed")
    shaped = got.select("id", F.col("s").cast("decimal(38,10)").alias("s"), "c")
    assert got.schema["s"].dataType.scale == 10
    assert shaped.count() == 6000 and shaped.exceptAll(want).count() == 0


def test_decimal_sums_keep_all_digits(spark):
    df = spark.createDataFrame([(1, Decimal("0.0000000001")), (2, Decimal("12345678901234567.0000000001"))], "id int, m decimal(28,10)")
    got = ordered.running_sums(df, [], ["id"], {"s": "m"}).orderBy("id").collect()
    assert got[1].s == Decimal("12345678901234567.0000000002")


def test_empty(spark, skewed):
    none = skewed.limit(0)
    assert ordered.row_numbers(none, ["g"], ["v"]).count() == 0
    assert ordered.global_ntile(none, ["v"], 3).count() == 0


def test_rank_match(spark):
    rows = spark.createDataFrame(
        [("t1", "p", 5.0), ("t2", "p", 9.0), ("t3", "p", 5.0), ("t4", "q", 1.0), ("t5", "r", 1.0)], "tile string, adm1 string, floor_area double"
    )
    samples = spark.createDataFrame(
        [("p", 1, 3.0), ("p", 2, 1.0), ("p", 3, 2.0), ("p", 4, 9.0), ("q", 1, 7.0)], "adm1 string, slot long, sample double"
    )
    got = rank.rank_match(rows, samples, "adm1", "floor_area", ["tile"])
    # The largest area gets the smallest sample; ties go by tile; r has no sample; 9.0 is left over.
    assert {(r.tile, r.sample) for r in got.collect()} == {("t2", 1.0), ("t1", 2.0), ("t3", 3.0), ("t4", 7.0)}
