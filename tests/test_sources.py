import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tileframe.operators import profile
from tileframe.plans import pings as ping_jobs
from tileframe.sources import readers, workspace, writers


def test_parquet_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(3), path)
    with pytest.raises(AnalysisException):
        writers.write_parquet(spark.range(4), path)
    writers.write_parquet(spark.range(5), path, overwrite=True)
    assert spark.read.parquet(path).count() == 5


def test_partitioned_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "days")
    both = spark.createDataFrame([(1, "d1", "p"), (2, "d2", "p"), (3, "d2", "q")], "id int, event_date string, adm1 string")
    ping_jobs.write_days(both, path, ["event_date", "adm1"])
    ping_jobs.write_days(spark.createDataFrame([(9, "d2", "p")], both.schema), path, ["event_date", "adm1"])
    back = spark.read.parquet(path)
    assert {tuple(r) for r in back.select("id", "event_date", "adm1").collect()} == {(1, "d1", "p"), (9, "d2", "p"), (3, "d2", "q")}
    audit = writers.partition_counts(back, ["event_date"])
    assert {tuple(r) for r in audit.collect()} == {("d1", 1), ("d2", 2)}
    nested = readers.read_nested_parquet(spark, f"{path}/event_date=*")
    assert nested.columns == ["id"] and nested.count() == 3
    pruned = back.filter("event_date = 'd1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in pruned


def test_audited_write_counts_what_it_writes(spark, tmp_path):
    path = str(tmp_path / "audited")
    rows = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, 'd1', IF(id % 100 = 1, NULL, 'd2')) AS day", "id * 2 AS rows")
    named = rows.where("day IS NOT NULL")
    got = writers.write_audited(named, path, "day", ["d1", "d2", "d3"], "first")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in writers.partition_counts(spark.read.parquet(path), ["day"]).collect()}
    assert sum(r["rows"] for r in got.collect()) == named.count()
    # The same run again writes nothing, whatever comes in.
    again = writers.write_audited(named.limit(3), path, "day", ["d1"], "first")
    assert sorted(again.collect()) == sorted(got.collect()) and spark.read.parquet(path).count() == named.count()
    # Another run replaces its own days only; keys that nobody named are counted all the same.
    other = writers.write_audited(named.where("day = 'd1'").limit(5), path, "day", ["d1"], "second")
    assert [tuple(r) for r in other.collect()] == [("d1", 5)]
    unnamed = writers.write_audited(rows, str(tmp_path / "other"), "day", ["d1"], "first")
    assert {tuple(r) for r in unnamed.collect()} == {tuple(r) for r in writers.partition_counts(rows, ["day"]).collect()}
    assert writers.write_audited(named.where("false"), str(tmp_path / "none"), "day", ["d1"], "first").count() == 0
    with pytest.raises(ValueError, match="at most"):
        writers.write_audited(named, path, "day", [str(i) for i in range(1001)], "third")


def test_audit_counts_behind_the_shuffle(spark, tmp_path):
    """Tasks before a shuffle can run twice; the tasks that write are counted once."""
    seen = Observation()
    df = spark.range(100).selectExpr("id", "id % 3 AS day").hint("rebalance", "day").observe(seen, F.count(F.lit(1)).alias("n"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange")


def test_csv(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("a", "1,000", "2.345"), ("b", "7", None)], "Province string, `Population 2021` string, ratio string")
    writers.write_csv(df, path)
    back = readers.read_csv_table(spark, path, numbers=["Population 2021"], round_to={"ratio": 2}, columns=["Province", "Population 2021", "ratio"])
    assert {tuple(r) for r in back.collect()} == {("a", None, 2.35), ("b", 7.0, None)}
    writers.write_csv_top(spark.range(1000), path, [F.desc("id")], 3)
    assert sorted(int(r.id) for r in readers.read_csv_table(spark, path).collect()) == [997, 998, 999]


def test_catalog(spark, tmp_path):
    rows = spark.createDataFrame([(1, "TH", ["x", "y"]), (2, "IN", ["z"])], "place_id int, country string, labels array<string>")
    rows.write.partitionBy("country").option("path", str(tmp_path / "c")).saveAsTable("some_places")
    try:
        got = readers.read_catalog_rows(spark, "some_places", F.col("country") == "TH", ["place_id", "labels"])
        assert [tuple(r) for r in got.collect()] == [(1, ["x", "y"])]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters" in plan and "country" in plan.split("PartitionFilters")[1].split("]")[0]
        assert ("default", "some_places") in [(d.rsplit(".")[-1], t) for d, t in readers.list_catalog_tables(spark, "default")]
    finally:
        spark.sql("DROP TABLE some_places")


def test_existence_probe(spark):
    assert spark.range(0).isEmpty() and not spark.range(1).isEmpty()


def test_stored_tables_go_to_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    df = workspace.stored(spark.range(5).withColumn("r", F.rand()), "draws")
    assert folder in df.inputFiles()[0]
    assert df.collect() == df.collect()
    assert workspace.is_small(df, 5) and not workspace.is_small(df, 4)


def test_profiles_equal_pandas(spark):
    df = spark.range(1001).selectExpr("IF(id % 10 = 0, NULL, CAST(id * id % 977 AS DOUBLE)) AS a", "CAST(id % 7 AS INT) AS b", "IF(id % 3 = 0, 'x', NULL) AS c")
    pdf = df.toPandas()
    got = {r.column: r for r in profile.profile_numeric(df, ["a", "b"]).collect()}
    for c in ("a", "b"):
        want = pdf[c].describe()
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[theirs])
    nulls = {r.column: (r.nulls, r.non_nulls) for r in profile.profile_nulls(df).collect()}
    assert nulls == {c: (int(pdf[c].isna().sum()), int(pdf[c].notna().sum())) for c in pdf.columns}


def test_histogram(spark):
    import numpy as np

    df = spark.range(500).selectExpr("CAST(id * 37 % 101 AS DOUBLE) AS v", "id % 2 AS g", "5D AS same")
    got = {r.bin: r.rows for r in profile.histogram(df, "v", 10).collect()}
    want, _ = np.histogram([r.v for r in df.collect()], 10)
    assert [got[i] for i in range(10)] == list(want)
    within = profile.histogram(df, "v", 7, low=0, high=50)
    assert sum(r.rows for r in within.collect()) == df.filter("v <= 50").count()
    assert [(r.g, r.bin, r.rows) for r in profile.histogram(df, "same", 4, group="g").orderBy("g").collect()] == [(0, 0, 250), (1, 0, 250)]


def test_histogram_with_one_bound(spark):
    from tileframe.operators import profile

    df = spark.range(11).selectExpr("CAST(id AS DOUBLE) AS v")
    assert sum(r["rows"] for r in profile.histogram(df, "v", low=5).collect()) == 6
    assert sum(r["rows"] for r in profile.histogram(df, "v", high=4).collect()) == 5


def test_repeated_overrides_do_not_multiply_rows(spark):
    from tileframe.operators import tables

    df = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    twice = spark.createDataFrame([("b", 3.0), ("b", 5.0)], "k string, v double")
    assert sorted(tables.override_values(df, twice, "k", "v").collect()) == [("a", 1.0), ("b", 5.0)]


def test_listing_leaves_temporary_views_out(spark):
    spark.sql("CREATE DATABASE listed_alone")
    spark.range(3).write.saveAsTable("listed_alone.some_rows")
    spark.range(5).createOrReplaceTempView("passing_view")
    try:
        assert [t for _, t in readers.list_catalog_tables(spark, "listed_alone")] == ["some_rows"]
    finally:
        spark.catalog.dropTempView("passing_view")
        spark.sql("DROP DATABASE listed_alone CASCADE")
