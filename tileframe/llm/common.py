"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tileframe.sources import workspace

#: Runs of these six ASCII characters separate words; any other character belongs to one.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
_MAX_BROADCAST_ROWS = 1_000_000
_SALTS = 32

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

__all__ = ["SPACE", "SPACE_CHARS", "join_groups", "settled", "stored", "text_or_empty", "words_of"]


def stored(df: DataFrame, name: str = "stage", batch_rows: int | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back. The shuffle files of the writing job are not
    needed after that, so Spark is asked to remove them at once where it can. ``batch_rows`` bounds the rows that a
    Python function of the job is given at a time."""
    conf = df.sparkSession.conf
    wanted = {}
    if conf.get(_CLEANUP, None) is not None:
        wanted[_CLEANUP] = "true"
    if batch_rows is not None:
        wanted[_BATCH_ROWS] = str(min(batch_rows, int(conf.get(_BATCH_ROWS)) if int(conf.get(_BATCH_ROWS)) > 0 else batch_rows))
    before = {key: conf.get(key) for key in wanted if conf.isModifiable(key)}
    for key in before:
        conf.set(key, wanted[key])
    try:
        return workspace.stored(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; an empty array where there is none."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE, -1))


def join_groups(rows: DataFrame, groups: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a table to facts about its groups, one row per group, where any key may be hot.

    The groups (``key`` and facts, already stored or cheap to count) are broadcast if they are at most
    a million rows. Beyond that both sides are salted, so that a hot key is spread over many tasks.
    """
    if groups.count() <= _MAX_BROADCAST_ROWS:
        return rows.join(F.broadcast(groups), key, how)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns if c != key][:1]), F.lit(_SALTS))
    many = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(_SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", salt).join(many, [key, "_salt"], how).drop("_salt")


def settled(rows: DataFrame, *names: str) -> DataFrame:
    """``rows`` with the named columns computed here and once.

    A filter on a computed column would otherwise be pushed below its projections, with all expressions copied into
    each other; nothing is pushed through a generator."""
    rest = [c for c in rows.columns if c not in names]
    return rows.select(*rest, F.inline(F.array(F.struct(*names))))

