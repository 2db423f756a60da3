"""Raw rows to typed staging rows; lazy, as a view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drumlin.contract import EARLIEST, REQUIRED, TEXT_KEYS
from drumlin.functions.keys import now
from drumlin.functions.payload import RAISE, integer_field, metric_field, text_field


def stage(raw: DataFrame, as_of=None, on_error: str = RAISE, keep: Sequence[str] = ()) -> DataFrame:
    """Keep complete rows between the earliest date and ``as_of``, and type the payload keys; columns of ``keep`` stay."""
    event_time = F.col("timestamp").cast("timestamp")
    return (
        raw.dropna(subset=list(REQUIRED))
        .filter((event_time >= F.lit(EARLIEST).cast("timestamp")) & (event_time <= now(as_of)))
        .select(
            "event_id",
            "device_id",
            "event_type",
            event_time.alias("event_timestamp"),
            F.col("ingestion_timestamp").cast("timestamp").alias("ingestion_timestamp"),
            *[text_field("payload", key).alias(key) for key in TEXT_KEYS],
            metric_field("payload", "metric_value", on_error).alias("metric_value"),
            integer_field("payload", "duration_ms", on_error).alias("duration_ms"),
            F.col("payload").alias("raw_payload"),
            "source_api",
            *keep,
        )
    )
