"""Small table helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.sources.workspace import broadcast_if_small, stored

#: Groups with more than this share of what one task should hold are dealt to several tasks.
_HOT = 32


def same_columns(*frames: DataFrame) -> None:
    """Raise unless all tables have the same columns in the same order with the same types."""
    first = frames[0]
    for other in frames[1:]:
        if other.dtypes != first.dtypes:
            raise ValueError(f"schema mismatch: {first.dtypes} and {other.dtypes}")


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name."""
    return reduce(DataFrame.unionByName, frames)


def with_group_totals(df: DataFrame, keys: Sequence[str], totals: Sequence[Column]) -> DataFrame:
    """Add totals of each row's group.

    Same rows as a window without an order, but in two stages: partial totals are combined before the
    shuffle, and the totals (one stored row per group) are joined back by ``salted_join``, so a group that holds a
    third of all rows is never gathered in one task. Rows with a NULL key are dropped.
    """
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    summed = df.filter(known).groupBy(*keys).agg(*totals, F.count(F.lit(1)).alias("_rows"))
    return salted_join(df, stored(summed, "totals"), keys, "_rows")


def salted_join(rows: DataFrame, facts: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """Inner join of rows to the facts of their group, even where one group holds most of the rows.

    ``facts`` has one row per group, is cheap to read, and tells in ``size`` how many rows its group has. A
    group is hot if it has more than 1/32 of what one task would hold if all tasks held the same; there can be no more
    than 32 such groups for each shuffle partition, so their list may be broadcast. Rows of a hot group get a
    salt from a hash of the whole row, as many salts as the group has such portions, and its facts are repeated for each salt;
    all other groups have the one salt 0. This needs neither adaptive execution nor a broadcast of the facts.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    portion = max(1, (facts.agg(F.sum(size)).first()[0] or 0) // (_HOT * tasks))
    names = [f"_k{i}" for i in range(len(keys))]
    dealt = facts.withColumn("_salts", F.ceil(F.col(size) / F.lit(portion)).cast("int"))
    hot = dealt.filter(F.col("_salts") > 1).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_salts").alias("_many"))
    same = reduce(Column.__and__, [F.col(k) == F.col(n) for k, n in zip(keys, names)])
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.col("_many"))
    salted = rows.join(F.broadcast(hot), same, "left").withColumn("_salt", F.coalesce(spread, F.lit(0)).cast("int")).drop(*names, "_many")
    repeated = dealt.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts", size)
    return salted.join(repeated, [*keys, "_salt"]).drop("_salt")


def override_values(df: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Replace the value of the keys listed in a small (key, value) table; an override wins over NULL too.

    Of several overrides of one key the largest counts, so rows are never multiplied."""
    new = F.max(F.col(value).cast(df.schema[value].dataType)).alias("_new")
    changed = broadcast_if_small(overrides.groupBy(key).agg(new, F.lit(True).alias("_set")))
    return (
        df.join(changed, key, "left")
        .withColumn(value, F.when(F.col("_set"), F.col("_new")).otherwise(F.col(value)))
        .select(*df.columns)
    )


def only_groups(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*names))


def without_groups(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Leave out the named groups; rows with a NULL name are left out too, as in SQL."""
    return df.filter(~F.col(column).isin(*names))
