"""Column profiles of large tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.operators.ordered import running_sums
from tileframe.operators.tables import salted_join
from tileframe.sources.workspace import stored

_QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def _stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) rows, one per non-null number."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("c")).select("c.*").filter(F.col("value").isNotNull())


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum of each column.

    Quartiles interpolate linearly between neighbours. They come from running counts over the
    distinct values in order, so no task ever holds all values of a column, as the exact
    percentile aggregate would.
    """
    values = _stacked(df, columns)
    basic = values.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    counted = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    ordered = running_sums(counted, ["column"], ["value"], {"_through": "_n"})
    # One row per profiled column, so small by construction.
    sizes = F.broadcast(basic.select("column", "count"))
    folds = []
    for name, q in _QUARTILES.items():
        at = F.lit(q) * (F.col("count") - 1)
        for end, place in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("_through") - F.col("_n") <= place) & (place < F.col("_through"))
            folds.append(F.max(F.when(here, F.col("value"))).alias(f"_{name}_{end}"))
    picked = ordered.join(sizes, "column").groupBy("column").agg(*folds)

    def interpolated(name: str, q: float):
        at = F.lit(q) * (F.col("count") - 1)
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (lo + (hi - lo) * (at - F.floor(at))).alias(name)

    return basic.join(F.broadcast(picked), "column").select(
        "column", "count", "mean", "std", "min", *[interpolated(n, q) for n, q in _QUARTILES.items()], "max"
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    """Per column: nulls and non-nulls, in one pass over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)]
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                (F.col("_all") - F.col(f"_{i}")).alias("nulls"),
                F.col(f"_{i}").alias("non_nulls"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.explode(lines).alias("l")).select("l.*")


def histogram(
    df: DataFrame, value: str, bins: int = 10, group: str | None = None,
    low: float | None = None, high: float | None = None,
) -> DataFrame:
    """Rows per bin of equal width, the last bin closed: (group, bin, start, stop, rows).

    The range is that of the data (of each group), unless given; values outside are left out.
    Bins without rows are not listed.
    """
    rows = df.filter(F.col(value).isNotNull())
    keys = [group] if group else []
    if low is None or high is None:
        # One row in all, or one per group.
        limits = rows.groupBy(*keys).agg(F.min(value).alias("_low"), F.max(value).alias("_high"), F.count(F.lit(1)).alias("_rows"))
        if group:
            # A group with most of the rows is dealt to many tasks.
            rows = salted_join(rows, stored(limits.filter(F.col(group).isNotNull()), "limits"), keys, "_rows")
        else:
            rows = rows.select(
                "*", limits.select("_low").scalar().alias("_low"), limits.select("_high").scalar().alias("_high")
            )
    else:
        rows = rows.withColumns({"_low": F.lit(float(low)), "_high": F.lit(float(high))})
    if low is not None:
        rows = rows.withColumn("_low", F.lit(float(low)))
    if high is not None:
        rows = rows.withColumn("_high", F.lit(float(high)))
    rows = rows.filter((F.col(value) >= F.col("_low")) & (F.col(value) <= F.col("_high")))
    width = (F.col("_high") - F.col("_low")) / bins
    nth = F.coalesce(F.floor(F.try_divide(F.col(value) - F.col("_low"), width)), F.lit(0)).cast("int")
    counted = rows.groupBy(*keys, F.least(nth, F.lit(bins - 1)).alias("bin"), "_low", "_high").agg(
        F.count(F.lit(1)).alias("rows")
    )
    return counted.select(
        *keys,
        "bin",
        (F.col("_low") + width * F.col("bin")).alias("start"),
        (F.col("_low") + width * (F.col("bin") + 1)).alias("stop"),
        "rows",
    )
