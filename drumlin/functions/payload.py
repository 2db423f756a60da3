"""Typed access to the keys of a VARIANT payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from drumlin.contract import METRIC

# How a value of the wrong type is treated: stop the query, or read it as NULL.
RAISE, NULL = "raise", "null"


def text_field(payload: str, key: str) -> Column:
    """The key as text; a missing key and a JSON null are both NULL."""
    return F.variant_get(F.col(payload), f"$.{key}", "string")


def metric_field(payload: str, key: str, on_error: str = RAISE) -> Column:
    """The key as an exact decimal; quoted numbers count as numbers."""
    get = F.variant_get if on_error == RAISE else F.try_variant_get
    return get(F.col(payload), f"$.{key}", METRIC.simpleString())


def integer_field(payload: str, key: str, on_error: str = RAISE) -> Column:
    """The key as an integer, by way of its text so that 1500.5 is an error, not 1500."""
    text = text_field(payload, key)
    return text.cast("int") if on_error == RAISE else text.try_cast("int")
