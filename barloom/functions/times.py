"""Time coercion; the session time zone is UTC, so naive values are read as UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc(c: Column, zone: str | None = None) -> Column:
    """Timestamp in UTC: zoned values are converted, naive ones taken as UTC or as local to ``zone``."""
    stamp = c.cast("timestamp")
    return F.to_utc_timestamp(stamp, zone) if zone else stamp


def iso_utc(c: Column) -> Column:
    """Parse ISO-8601 text (``...Z`` or naive = UTC); NULL where it is not a time."""
    return c.try_cast("timestamp")


def micros(c: Column) -> Column:
    """Microseconds since the epoch, for zoned and zone-less timestamps alike."""
    return F.unix_micros(c.cast("timestamp"))


def period_start(c: Column, grain: str) -> Column:
    """First day of the storage period (``year``, ``month`` or ``day``) a time falls into."""
    if grain not in ("year", "month", "day"):
        raise ValueError(f"unsupported partition grain: {grain}")
    return F.to_date(F.date_trunc(grain, c))
