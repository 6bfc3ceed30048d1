"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most keys that are counted in one pass while they are written.
AUDITED = 1_000


def write_parquet(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """Parquet; fails on an existing path unless told to overwrite."""
    df.write.mode("overwrite" if overwrite else "errorifexists").parquet(path)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """One folder per key (``day=...``) in a single job; only folders in the input are replaced.

    The rebalance hint gathers each key's rows into few files, and lets AQE cut a key that
    holds a large share of the rows into many tasks.
    """
    _write_folders(df.hint("rebalance", *by), path, by)


def _write_folders(df: DataFrame, path: str, by: Sequence[str]) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def partition_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per written partition, the audit of a partitioned sink."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def write_audited(df: DataFrame, path: str, by: str, values: Sequence, run: str) -> DataFrame:
    """``write_partitioned`` by one column, with the rows of each folder counted by the writing tasks themselves.

    ``values``: the keys that the run is meant to hold; at most ``AUDITED``. Rows under other keys are written too; if there are
    any, all folders below ``path`` are counted from the footers of their files instead. The counts (``by, rows``; folders without rows of this
    run are left out) are stored under ``path/_audits`` once all is written. A run whose audit is there has been written and is
    not written again, so a job that is repeated after a failure repeats only what is missing.

    The count stands behind the shuffle, in the tasks that write: of several attempts at such a task only one counts, whereas
    tasks before a shuffle may be run again and counted twice when an executor is lost.
    """
    spark, kept = df.sparkSession, sorted(set(values))
    if len(kept) > AUDITED:
        raise ValueError(f"at most {AUDITED} keys can be counted while they are written")
    audit = f"{path.rstrip('/')}/_audits/run={run}"
    kind = df.schema[by].dataType
    shape = T.StructType([T.StructField(by, kind), T.StructField("rows", T.LongType())])
    try:
        done = spark.read.schema(shape).parquet(f"{audit}/counts")
        # A failure while the audit itself was written leaves an empty one.
        if not done.isEmpty():
            return done
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    seen = Observation()
    counts = [F.count_if(F.col(by) == F.lit(v)).alias(f"_{n}") for n, v in enumerate(kept)]
    _write_folders(df.hint("rebalance", by).observe(seen, F.count(F.lit(1)).alias("all"), *counts), path, [by])
    found = seen.get
    rows = [(v, found[f"_{n}"]) for n, v in enumerate(kept) if found[f"_{n}"]]
    if sum(n for _, n in rows) == found["all"]:
        audited = spark.createDataFrame(rows, shape)
    else:
        audited = partition_counts(spark.read.schema(df.schema).parquet(path), [by]).select(by, "rows")
    write_parquet(audited.coalesce(1), f"{audit}/counts", overwrite=True)
    return spark.read.schema(shape).parquet(f"{audit}/counts")


def write_csv(df: DataFrame, path: str, overwrite: bool = True) -> None:
    """CSV files with a header, written by the executors."""
    df.write.mode("overwrite" if overwrite else "errorifexists").option("header", True).csv(path)


def write_csv_top(df: DataFrame, path: str, order: Sequence, rows: int = 300) -> None:
    """The first rows by an order, as CSV; Spark keeps only the top rows of each task."""
    write_csv(df.orderBy(*order).limit(rows), path)
