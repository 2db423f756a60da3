"""Device dimension: latest attributes and activity per device.

The dimension is a fold over device-days. ``device_days`` is small next to the
events and each day can be recomputed alone, so a refresh after a load reads
the events of the touched days only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drumlin.contract import DIMENSION
from drumlin.functions.keys import now, whole_days

ATTRIBUTES = ("device_model", "os_version", "country")
# The latest event wins as a whole row; of two at the same time, the larger id.
RECENCY = ("event_timestamp", "event_id")


def latest_attributes(staging: DataFrame) -> DataFrame:
    """Attributes of each device's latest event; one candidate per device leaves each task."""
    latest = F.max_by(F.struct(*ATTRIBUTES), F.struct(*RECENCY))
    return staging.groupBy("device_id").agg(latest.alias("latest")).select("device_id", "latest.*")


def device_days(staging: DataFrame) -> DataFrame:
    return (
        staging.withColumn("metric_date", F.to_date("event_timestamp"))
        .groupBy("device_id", "metric_date")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.min("event_timestamp").alias("first_event_time"),
            F.max_by(F.struct(*RECENCY, *ATTRIBUTES), F.struct(*RECENCY)).alias("latest"),
        )
    )


def from_device_days(days: DataFrame, as_of=None) -> DataFrame:
    recency = F.struct(*[f"latest.{name}" for name in RECENCY])
    return _finish(
        days.groupBy("device_id").agg(
            F.max_by("latest", recency).alias("latest"),
            F.min("first_event_time").alias("first_seen_at"),
            F.max("latest.event_timestamp").alias("last_seen_at"),
            F.sum("events").alias("total_events"),
            F.count(F.lit(1)).alias("active_days"),
        ),
        as_of,
    )


def dim_devices(staging: DataFrame, as_of=None) -> DataFrame:
    """The dimension straight from staging in one scan and one shuffle.

    The set of active days is bounded: staging keeps dates from the earliest
    date to ``as_of`` only.
    """
    return _finish(
        staging.groupBy("device_id").agg(
            F.max_by(F.struct(*ATTRIBUTES), F.struct(*RECENCY)).alias("latest"),
            F.min("event_timestamp").alias("first_seen_at"),
            F.max("event_timestamp").alias("last_seen_at"),
            F.count(F.lit(1)).alias("total_events"),
            F.size(F.collect_set(F.to_date("event_timestamp"))).alias("active_days"),
        ),
        as_of,
    )


def _finish(devices: DataFrame, as_of) -> DataFrame:
    return (
        devices.select("*", *[F.col(f"latest.{name}").alias(name) for name in ATTRIBUTES])
        .withColumn("days_active_span", whole_days("last_seen_at", "first_seen_at"))
        .withColumn("dbt_updated_at", now(as_of))
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in DIMENSION])
    )
