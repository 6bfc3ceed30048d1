"""Ping enrichment: administrative tags, building visits, place visits, one job for all days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tileframe.functions.keys import event_day, from_epoch_ms
from tileframe.operators.cover import Cover
from tileframe.operators.ordered import global_ntile
from tileframe.operators.spatial_join import join_points
from tileframe.sources.writers import write_partitioned

DAY = "event_date"


def tag_pings(
    pings: DataFrame,
    areas: DataFrame | Cover,
    columns: Sequence[str] = ("adm1", "adm2", "adm3"),
    ts: str = "ts",
    lon: str = "lon",
    lat: str = "lat",
    zone: str | None = None,
    predicate: str = "intersects",
    **options,
) -> DataFrame:
    """Pings with their day and their administrative areas; pings without place or area are dropped.

    The day is that of the session time zone, or of ``zone`` if given. Coordinates may be text.
    """
    located = pings.withColumns(
        {lon: F.col(lon).try_cast("double"), lat: F.col(lat).try_cast("double")}
    ).filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    dated = located.withColumn(DAY, event_day(located, ts, zone))
    return join_points(dated, areas, columns, predicate=predicate, x=lon, y=lat, **options)


def building_visits(
    pings: DataFrame,
    footprints: DataFrame | Cover,
    columns: Sequence[str] = ("building_id",),
    ts_ms: str = "ts_ms",
    lon: str = "lon",
    lat: str = "lat",
    zone: str | None = None,
    drop: Sequence[str] = ("consent",),
    day_type: str = "date",
    **options,
) -> DataFrame:
    """Pings strictly inside a building, with the local time and day of their epoch milliseconds.

    ``day_type``: "string" writes the day as text once for each ping, not for each building around it."""
    slim = pings.drop(*drop).withColumn("event_time", from_epoch_ms(F.col(ts_ms)))
    dated = slim.withColumn(DAY, event_day(slim, "event_time", zone).cast(day_type))
    return join_points(dated, footprints, columns, predicate="within", x=lon, y=lat, **options)


def place_visits(
    tagged: DataFrame,
    footprints: DataFrame | Cover,
    columns: Sequence[str] = ("building_id", "place_id"),
    adm1: str = "adm1",
    footprint_adm1: str = "adm1",
    ts: str = "ts",
    lon: str = "lon",
    lat: str = "lat",
    **options,
) -> DataFrame:
    """Tagged pings in or on a building of their own province, with their day.

    The province is part of the join key, next to the cell; provinces without buildings give no rows.
    """
    dated = tagged if DAY in tagged.columns else tagged.withColumn(DAY, event_day(tagged, ts))
    return join_points(
        dated, footprints, columns, predicate="intersects", x=lon, y=lat, keys={adm1: footprint_adm1}, **options
    )


def busiest_day(pings: DataFrame, day: str = DAY) -> DataFrame:
    """The day with most pings, as one row; the earliest of equals."""
    counts = pings.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
    return counts.orderBy(F.desc("rows"), day).limit(1)


def busy_day_visits(
    pings: DataFrame,
    footprints: DataFrame | Cover,
    columns: Sequence[str] = ("building_id",),
    key: Sequence[str] = ("event_id",),
    batches: int = 12,
    batch: str = "part",
    ts_ms: str = "ts_ms",
    lon: str = "lon",
    lat: str = "lat",
    zone: str | None = None,
    drop: Sequence[str] = ("consent",),
    **options,
) -> DataFrame:
    """The building visits of the day with most pings, in batches of equally many pings in order of time.

    The pings of the day are numbered over sorted runs, so the day is never sorted in one task, and
    all batches are joined in one job. ``key`` breaks ties of time and should make the order unique. Pings
    without a place count in the batches, though they visit nothing. Adds ``event_time``, the day and ``batch``.
    """
    slim = pings.drop(*drop).withColumn("event_time", from_epoch_ms(F.col(ts_ms)))
    dated = slim.withColumn(DAY, event_day(slim, "event_time", zone))
    # One row, so the other pings leave before anything is sorted.
    day = F.broadcast(busiest_day(dated).select(DAY))
    numbered = global_ntile(dated.join(day, DAY, "left_semi"), ["event_time", *key], batches, batch)
    return join_points(numbered, footprints, columns, predicate="within", x=lon, y=lat, **options)


def write_busy_day(visits: DataFrame, path: str, batch: str = "part", day: str = DAY) -> None:
    """Write batched visits as ``date=.../part=...`` folders in one job; other days and parts on disk stay."""
    write_partitioned(visits.withColumnRenamed(day, "date"), path, ["date", batch])


def write_days(df: DataFrame, path: str, by: Sequence[str] = (DAY,)) -> None:
    """Write all days (and provinces) in one job, a folder each; other days on disk stay."""
    write_partitioned(df, path, by)
