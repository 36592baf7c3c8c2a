"""Time functions, as column expressions. ``as_of`` stands for the clock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, functions as F

ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_first(col: Column, formats: Sequence[str] = ISO_FORMATS) -> Column:
    """First format that fits; null for blank or unparsable text."""
    text = F.nullif(F.trim(col), F.lit(""))
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in formats])


def parse_utc(col: Column) -> Column:
    """``2026-01-31T10:00:00Z`` as a zone-less time."""
    return F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ssX")).cast("timestamp_ntz")


def wall_clock(col: Column, zone: str) -> Column:
    """ISO time with offset as the local wall-clock time of ``zone``.

    Text without an offset is taken as already local.
    """
    aware = F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    local = F.convert_timezone(F.lit("UTC"), F.lit(zone), aware.cast("timestamp_ntz"))
    bare = F.try_to_timestamp(col, F.lit("yyyy-MM-dd'T'HH:mm:ss")).cast("timestamp_ntz")
    return F.coalesce(local, bare)


def shift_zone(ts: Column, zone_from: str, zone_to: str) -> Column:
    """Zone-less time of one zone as the zone-less time of another."""
    return F.convert_timezone(F.lit(zone_from), F.lit(zone_to), ts.cast("timestamp_ntz"))


def before(as_of: datetime, interval: str) -> Column:
    return F.lit(as_of) - F.expr(f"INTERVAL {interval}")


def age_days(ts: Column, as_of: datetime) -> Column:
    """Whole days from ``ts`` to ``as_of``, rounded down; null without ``ts``."""
    seconds = F.timestamp_diff("SECOND", ts.cast("timestamp_ntz"), F.lit(as_of).cast("timestamp_ntz"))
    return F.floor(seconds / 86400).cast("bigint")


def todate_windows(as_of: datetime) -> dict[str, tuple[datetime, datetime]]:
    """Start and last day of the running week (from Monday), month and year."""
    day = datetime(as_of.year, as_of.month, as_of.day)
    week = day - timedelta(days=day.weekday())
    month = day.replace(day=1)
    next_month = (month + timedelta(days=32)).replace(day=1)
    return {
        "week": (week, week + timedelta(days=6)),
        "month": (month, next_month - timedelta(days=1)),
        "year": (datetime(day.year, 1, 1), datetime(day.year, 12, 31)),
    }


def calendar(since: date, until: date) -> Column:
    """Array of all days from ``since`` to ``until``, both included."""
    return F.sequence(F.lit(since), F.lit(until), F.expr("INTERVAL 1 DAY"))
