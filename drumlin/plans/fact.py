"""Daily fact: one row per device, day and event type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drumlin.contract import FACT, GRAIN
from drumlin.functions.keys import now, surrogate_key
from drumlin.operators import facets


def _dated(staging: DataFrame) -> DataFrame:
    return staging.withColumn("metric_date", F.to_date("event_timestamp"))


def fact_daily(staging: DataFrame, as_of=None) -> DataFrame:
    return fold(facets.value_counts(_dated(staging), GRAIN), as_of)


def fact_of_job(staging: DataFrame, as_of=None) -> DataFrame:
    """The same rows for a job that runs now. It counts the groups first: if none is hot, one shuffle
    does instead of three."""
    return fold(facets.value_counts(facets.dealt(_dated(staging), GRAIN), GRAIN), as_of)


def fold(counts: DataFrame, as_of=None) -> DataFrame:
    """The fact from counts by grain, facet and value."""
    daily = (
        counts.groupBy(*GRAIN)
        .agg(
            *[facets.mode(name).alias(name) for name in ("device_model", "os_version", "country")],
            facets.event_count().alias("event_count"),
            facets.distinct("session_id").alias("unique_sessions"),
            facets.distinct("user_id").alias("unique_users"),
            F.min("first_time").alias("first_event_time"),
            F.max("last_time").alias("last_event_time"),
            F.try_divide(F.sum("duration_sum"), F.sum("duration_count")).alias("avg_duration_ms"),
            F.sum("duration_sum").alias("total_duration_ms"),
            F.try_divide(F.sum("metric_sum"), F.sum("metric_count")).alias("avg_metric_value"),
            F.sum("metric_sum").alias("total_metric_value"),
        )
    )
    return (
        daily.withColumn("metric_id", surrogate_key())
        .withColumn("dbt_updated_at", now(as_of))
        .select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT])
    )
