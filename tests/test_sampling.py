from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tileframe.functions import draws
from tileframe.operators import sampling


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(
        [("a", 2.0, 4.0, 3000), ("b", 1.0, 1.5, 150_000), ("none", 1.0, 2.0, 0), ("one", 3.0, 3.0, 1)],
        "adm1 string, lower double, upper double, n long",
    )


@pytest.mark.parametrize("draw", [sampling.gaussian_samples, sampling.uniform_samples])
def test_counts_bounds_and_repeatability(groups, draw):
    out = draw(groups, "adm1")
    stats = {
        r.adm1: r for r in out.groupBy("adm1").agg(
            F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"),
            F.min("sample").alias("lo"), F.max("sample").alias("hi"), F.avg("sample").alias("mean"), F.stddev("sample").alias("sd"),
        ).collect()
    }
    assert set(stats) == {"a", "b", "one"}
    for name, n, lo, hi in (("a", 3000, 2, 4), ("b", 150_000, 1, 1.5), ("one", 1, 3, 3)):
        s = stats[name]
        assert (s.n, s.slots, s["last"]) == (n, n, n) and lo <= s.lo <= s.hi <= hi
    spread = 1 / 6 if draw is sampling.gaussian_samples else 1 / 12**0.5
    assert stats["b"].mean == pytest.approx(1.25, abs=0.005) and stats["b"].sd == pytest.approx(0.5 * spread, rel=0.02)
    again = draw(groups.repartition(5), "adm1")
    assert out.exceptAll(again).count() == 0


def test_large_group_is_cut_into_pieces(groups):
    slots = sampling.sample_slots(groups, "n")
    parts = slots.filter("adm1 = 'b'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) <= 2 * sampling.CHUNK


def test_uniform_seed_matters(groups):
    one, two = (sampling.uniform_samples(groups.filter("adm1 = 'a'"), "adm1", seed=s) for s in (1, 2))
    assert one.select("sample").intersect(two.select("sample")).count() == 0


def test_bounds(spark):
    df = spark.createDataFrame([(3.0,), (2.456,)], "pop_to_hh double")
    rows = sampling.ratio_bounds(df).collect()
    assert [(r.upper, r.lower) for r in rows] == [(3.87, 2.13), (3.33, 1.59)]
    assert sampling.ratio_bounds(df, spread=2).first().upper == 3.58


def test_slots_are_spread_with_adaptive_defaults(spark):
    """Adaptive execution must not merge the pieces into one task."""
    other = spark.newSession()
    other.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    few = other.createDataFrame([(f"g{i}", 1.0, 2.0, 500_000) for i in range(4)], "adm1 string, lower double, upper double, n long")
    out = sampling.uniform_samples(few, "adm1").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(out) > 8 and sum(r["count"] for r in out) == 2_000_000


def test_normal_quantile_is_the_inverse(spark):
    chances = [1e-10, 0.00135, 0.01, 0.0749, 0.0751, 0.3, 0.5, 0.77, 0.9251, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in chances], "p double").select("p", draws.normal_quantile(F.col("p")).alias("x"))
    assert all(r.x == pytest.approx(NormalDist().inv_cdf(r.p), rel=1e-12, abs=1e-15) for r in df.collect())
    assert NormalDist().cdf(-3) == pytest.approx(draws.BELOW_THREE, rel=1e-13)


def test_cut_off_normal_has_the_right_shares(spark):
    """Shares of 200,000 draws below some places agree with the distribution cut off at three deviations."""
    out = spark.range(200_000).select(draws.normal_within_three(F.col("id").cast("string")).alias("x"))
    normal = NormalDist()
    whole = normal.cdf(3) - normal.cdf(-3)
    for at in (-2.9, -2, -1, 0, 0.5, 1.7, 2.95):
        assert out.filter(F.col("x") < at).count() / 200_000 == pytest.approx((normal.cdf(at) - normal.cdf(-3)) / whole, abs=0.004)
    assert out.filter("abs(x) > 3").count() == 0
