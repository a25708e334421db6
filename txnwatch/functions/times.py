"""Instants, epoch milliseconds and calendar-day bounds (session time zone UTC)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 instant with seconds and an offset; a bare date is not an instant
_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})$"


def at(moment: datetime) -> Column:
    """Literal instant. A value without a time zone is UTC, whatever zone the driver runs in."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(f"{moment.isoformat(sep=' ')}+00:00").cast("timestamp")


def parse_instant(text: Column) -> Column:
    """Timestamp of an ISO-8601 instant, NULL for any other text."""
    return F.when(text.rlike(_INSTANT), F.try_to_timestamp(text))


def iso_instant(ts: Column) -> Column:
    """ISO-8601 UTC text with milliseconds."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def display_time(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; text that is no timestamp stays as it is."""
    return F.coalesce(F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd HH:mm:ss"), text)


def day_start(day: Column) -> Column:
    return F.date_trunc("day", day)


def day_end(day: Column) -> Column:
    """Last millisecond of the day."""
    return F.date_trunc("day", day) + F.expr("INTERVAL '1' DAY - INTERVAL '0.001' SECOND")


def floor_to(value: Column, step: int) -> Column:
    """Start of the ``step``-wide cell that holds ``value`` (exact for longs)."""
    return value - F.pmod(value, F.lit(step).cast("long"))
