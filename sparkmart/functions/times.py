"""Dates and instants. All calendar arithmetic is in the session time zone (UTC)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_TEXT = "yyyyMMdd"


def instant(moment: datetime) -> Column:
    """A moment as a literal. Without a zone it is UTC, whatever zone the driver's system has."""
    return F.lit(moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc))


def from_epoch_micros(micros: Column) -> Column:
    return F.timestamp_micros(micros)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis.cast("bigint"))


def day_from_text(text: Column) -> Column:
    """``YYYYMMDD`` to a date."""
    return F.to_date(text, DAY_TEXT)


def day_to_text(day: Column) -> Column:
    return F.date_format(day, DAY_TEXT)


def midnights_between(start: Column, end: Column) -> Column:
    """Calendar days from ``start`` to ``end``, not full 24 hour periods."""
    return F.datediff(end, start)
