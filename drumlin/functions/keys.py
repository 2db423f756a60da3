"""Key and date expressions of the marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drumlin.contract import GRAIN
from drumlin.functions.clock import instant


def surrogate_key() -> Column:
    """md5 of device, ISO date and type joined by '-'; NULL if any part is NULL."""
    device, date, event_type = GRAIN
    dash = F.lit("-")
    return F.md5(F.concat(F.col(device), dash, F.col(date).cast("string"), dash, F.col(event_type)))


def whole_days(later: str, earlier: str) -> Column:
    """Whole 24-hour days between two timestamps (not calendar days)."""
    return F.extract(F.lit("DAY"), F.col(later) - F.col(earlier)).cast("int")


def now(as_of) -> Column:
    """The run's clock: ``as_of`` if given, else the query's start time."""
    return F.current_timestamp() if as_of is None else instant(as_of)
