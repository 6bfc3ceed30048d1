"""Join-key clean-up, ANSI-safe numbers, and event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def squash_name(name: Column) -> Column:
    """Lower-case a name and remove its blanks (``Chiang Mai`` -> ``chiangmai``)."""
    return F.lower(F.regexp_replace(name, " ", ""))


def snake_name(name: Column) -> Column:
    """Lower-case a name and turn each run of other characters than A-Z, 0-9 into ``_``."""
    return F.lower(F.regexp_replace(name, "[^a-zA-Z0-9]+", "_"))


def guard_key(key: Column, mark: str = "_") -> Column:
    """Prefix a digit-only key so that spreadsheet tools keep it as text."""
    return F.concat(F.lit(mark), key)


def unguard_key(key: Column, mark: str = "_") -> Column:
    return F.substring(key, len(mark) + 1, 2_000_000_000)


def to_number(text: Column) -> Column:
    """Text to double; NULL where the text is no number."""
    return text.try_cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Quotient; NULL where the divisor is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent_diff(value: Column, control: Column) -> Column:
    """Signed difference to a control value, in percent of the control."""
    return F.try_divide((value - control).cast("double") * 100, control.cast("double"))


def from_epoch_ms(millis: Column) -> Column:
    """Epoch milliseconds to timestamp."""
    return F.timestamp_millis(millis)


def zone_time(df: DataFrame, ts: str, zone: str) -> Column:
    """Wall time in ``zone``.

    Zoned timestamps are instants; zoneless ones are read as UTC wall time. Neither
    depends on the session time zone.
    """
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.col(ts))
    return F.convert_timezone(F.current_timezone(), F.lit(zone), F.col(ts).cast("timestamp_ntz"))


def event_day(df: DataFrame, ts: str, zone: str | None = None) -> Column:
    """Calendar day of an event: in ``zone`` if given, else in the session time zone."""
    return F.to_date(zone_time(df, ts, zone) if zone else F.col(ts))
