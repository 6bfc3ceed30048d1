"""Intermediate tables in the cluster's shared folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    Only a local session may fall back to a temporary folder; on a cluster an unset
    folder is an error, as a machine-local path would be lost with its machine.
    """
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tileframe-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a table once and read it back: cuts lineage, fixes the rows, survives executor loss."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discarded(table: DataFrame) -> None:
    """Remove the files of a table from ``stored`` that nothing will read again; what was made of it must be stored itself."""
    spark, jvm = table.sparkSession, table.sparkSession._jvm
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def is_small(df: DataFrame, max_rows: int = 200_000) -> bool:
    """Count a table against a bound. This is a job: use it on tables that are cheap to scan, such
    as control totals, truth sets, overrides, or aggregates of a stored table. The count is made of
    partial sums; a limit would gather rows in one task."""
    return df.count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast a table of checked size; beyond the bound Spark joins it by shuffle."""
    return F.broadcast(df) if is_small(df, max_rows) else df
