"""Time helpers. Every operator takes ``as_of`` instead of reading a clock."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def instant(as_of: datetime | None) -> Column:
    """``as_of`` as a timestamp column (naive means UTC); the query time if None."""
    if as_of is None:
        return F.current_timestamp()
    return F.timestamp_micros(F.lit(micros(as_of)))


def micros(value: datetime) -> int:
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return (value - _EPOCH) // timedelta(microseconds=1)


def minus_minutes(ts: Column, minutes: int) -> Column:
    return ts - F.make_dt_interval(mins=F.lit(minutes))


def minus_hours(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(hours=F.lit(hours))


def from_epoch_millis(ms: Column) -> Column:
    """Epoch milliseconds to a timestamp of whole seconds; 0 and NULL give NULL."""
    return F.date_trunc("second", F.timestamp_millis(F.nullif(ms, F.lit(0).cast("bigint"))))


def is_corrupt_time(ts: Column, last_year: int = 2100) -> Column:
    """Seconds read as milliseconds (or the reverse) land far in the future."""
    return F.year(ts) > F.lit(last_year)


def iso_text(as_of: datetime | None) -> Column:
    """ISO-8601 text of ``as_of`` with its offset, for composed ids."""
    if as_of is None:
        return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    if as_of.tzinfo is None:
        as_of = as_of.replace(tzinfo=timezone.utc)
    return F.lit(as_of.isoformat())
