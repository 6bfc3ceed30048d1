"""Row numbers, buckets and running sums over orders too large for one task.

A window without partitions, or with one group that holds a third of all rows, sorts that
whole group in one task. Here rows are range-partitioned on (group, order) and written once
as sorted runs; a hot group then spans many runs. What remains is one small table with a
line per run and group, whose prefix sums place each run within its group.

The runs are written because range bounds are sampled: a second evaluation could cut
elsewhere. The written table also survives the loss of executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tileframe.sources.workspace import broadcast_if_small, stored

RUN, POS = "_run", "_pos"
_MAX_OFFSETS = 500_000


def sorted_runs(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The table in total order as stored runs, with run number and position in the run.

    ``order`` should end in a unique key: ties would otherwise be placed at random.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    stamped = ranged.select(
        "*", F.spark_partition_id().alias(RUN), F.monotonically_increasing_id().alias(POS)
    )
    return stored(stamped, "runs")


def _group_window(group: Sequence[str]):
    return Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))


def _attach(runs: DataFrame, offsets: DataFrame, group: Sequence[str]) -> DataFrame:
    """Join run offsets back; NULL is a group of its own."""
    right = offsets.select(
        F.col(RUN).alias("_o_run"),
        *[F.col(g).alias(f"_o_{g}") for g in group],
        *[c for c in offsets.columns if c not in (RUN, *group)],
    )
    on = F.col(RUN) == F.col("_o_run")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_o_{g}"))
    joined = runs.join(broadcast_if_small(right, _MAX_OFFSETS), on)
    return joined.drop("_o_run", *[f"_o_{g}" for g in group])


def _before(value: str, group: Sequence[str]) -> Column:
    """Sum over the earlier runs of the group."""
    earlier = _group_window(group).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0))


def row_numbers(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "rank"
) -> DataFrame:
    """``row_number`` of each row in its group, for groups of any size."""
    runs = sorted_runs(df, [*group, *order])
    sizes = runs.groupBy(*group, RUN).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
    shift = sizes.select(*group, RUN, (_before("_n", group) - F.col("_first") + 1).alias("_shift"))
    numbered = _attach(runs, shift, group)
    return numbered.withColumn(name, F.col(POS) + F.col("_shift")).drop(RUN, POS, "_shift")


def global_ntile(
    df: DataFrame, order: Sequence[Column | str], buckets: int, name: str = "bucket"
) -> DataFrame:
    """``ntile`` over the whole table: bucket sizes differ by at most one, larger ones first."""
    runs = sorted_runs(df, order)
    sizes = runs.groupBy(RUN).agg(F.count(F.lit(1)).alias("_n"), F.min(POS).alias("_first"))
    shift = sizes.select(
        RUN,
        (_before("_n", []) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(_group_window([])).alias("_total"),
    )
    at = F.col(POS) + F.col("_shift")
    small = F.floor(F.col("_total") / F.lit(buckets)).cast("long")
    large_buckets = F.col("_total") % F.lit(buckets)
    in_large = large_buckets * (small + 1)
    bucket = F.when(at < in_large, F.floor(at / (small + 1)) + 1).otherwise(
        large_buckets + F.floor((at - in_large) / F.greatest(small, F.lit(1))) + 1
    )
    # The offsets have one row per written run, so their size is known to be small.
    return runs.join(F.broadcast(shift), RUN).withColumn(name, bucket.cast("int")).drop(
        RUN, POS, "_shift", "_total"
    )


def running_sums(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], sums: dict[str, str]
) -> DataFrame:
    """Running totals (inclusive) within each group: ``sums`` maps new names to value columns."""
    runs = sorted_runs(df, [*group, *order])
    in_run = (
        Window.partitionBy(*group, RUN).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = runs.groupBy(*group, RUN).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in sums.items()])
    before = totals.select(*group, RUN, *[_before(f"_t_{n}", group).alias(f"_b_{n}") for n in sums])
    local = runs.select("*", *[F.sum(v).over(in_run).alias(n) for n, v in sums.items()])
    joined = _attach(local, before, group)
    for n in sums:
        kind = local.schema[n].dataType
        if isinstance(kind, T.DecimalType):
            # One digit of room for the addition, which would otherwise cut the scale.
            kind = T.DecimalType(37, kind.scale)
        own = F.coalesce(F.col(n), F.lit(0).cast(kind)).cast(kind)
        joined = joined.withColumn(n, own + F.col(f"_b_{n}").cast(kind))
    return joined.drop(RUN, POS, *[f"_b_{n}" for n in sums])
