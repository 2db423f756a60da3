"""Run times. Whatever form a caller gives is turned into a UTC instant once, at entry."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc(value: datetime | str | None) -> datetime:
    """The instant in UTC: none is now; without a zone it is UTC, whatever the driver's own zone."""
    if value is None:
        return datetime.now(timezone.utc)
    if isinstance(value, str):
        value = datetime.fromisoformat(value.strip())
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def text(value: datetime | str | None) -> str:
    """The form in which notes keep an instant; equal instants are equal texts."""
    return utc(value).isoformat(sep=" ", timespec="microseconds")


def instant(value: datetime | str | None) -> Column:
    """A timestamp column; the text names its zone, so the driver's zone has no say."""
    return F.lit(text(value)).cast("timestamp")
