"""Rank-matched join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.operators.ordered import row_numbers


def rank_match(
    rows: DataFrame,
    samples: DataFrame,
    group: str,
    by: str,
    key: Sequence[str],
    sample_group: str | None = None,
    sample: str = "sample",
    sample_key: Sequence[str] = ("slot",),
    rank: str | None = None,
) -> DataFrame:
    """Give the n-th largest row of each group the n-th smallest sample of that group.

    ``key`` and ``sample_key`` break ties, so the match is the same on every run. Rows or samples
    in excess of the other side are dropped. ``rank`` keeps the rank under that name. The join is
    on (group, rank), so it stays even however large a group is.
    """
    sample_group = sample_group or group
    ranked = row_numbers(rows, [group], [F.desc(by), *key], "_rank")
    offered = row_numbers(
        samples.select(F.col(sample_group).alias("_group"), *sample_key, sample), ["_group"], [sample, *sample_key], "_nth"
    ).select("_group", "_nth", sample)
    on = (F.col(group) == F.col("_group")) & (F.col("_rank") == F.col("_nth"))
    matched = ranked.join(offered, on).drop("_group", "_nth")
    return matched.withColumnRenamed("_rank", rank) if rank else matched.drop("_rank")
