"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tileframe.functions.keys import to_number


def read_nested_parquet(spark: SparkSession, *paths: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All Parquet files below the paths (globs allowed), as one flat table.

    Folder names do not become columns. Give the schema to skip footer inference on large trees.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*paths)


def read_csv_table(
    spark: SparkSession,
    path: str,
    numbers: Sequence[str] = (),
    round_to: dict[str, int] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """CSV with a header; named columns become doubles, NULL where they hold no number."""
    raw = spark.read.option("header", True).csv(path)
    chosen = list(columns) if columns is not None else raw.columns
    rounding = round_to or {}

    def shaped(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name in numbers or name in rounding:
            value = to_number(value)
        if name in rounding:
            value = F.round(value, rounding[name])
        return value.alias(name)

    return raw.select(*[shaped(name) for name in chosen])


def read_catalog_rows(
    spark: SparkSession, table: str, condition: Column | str, columns: Sequence[str]
) -> DataFrame:
    """Rows of a catalog table; the condition and the column list reach the scan."""
    return spark.table(table).where(condition).select(*columns)


def list_catalog_tables(spark: SparkSession, database: str | None = None) -> list[tuple[str, str]]:
    """(database, table) names of a catalog, sorted; temporary views of the session are in no database."""
    tables = [t for t in spark.catalog.listTables(database) if not t.isTemporary]
    return sorted((".".join(t.namespace or []), t.name) for t in tables)
