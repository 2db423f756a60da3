"""Schemas and fixed values of the telemetry model."""

from __future__ import annotations

from pyspark.sql import types as T

# Event keys lifted to columns; every other key stays in the payload.
KNOWN_KEYS = (
    "event_id",
    "device_id",
    "event_type",
    "timestamp",
    "source_api",
    "ingestion_timestamp",
)

# Payload keys that staging extracts as text.
TEXT_KEYS = (
    "device_model",
    "os_version",
    "app_version",
    "user_id",
    "session_id",
    "country",
    "city",
)

# Column limits of the raw table, in characters.
MAX_LENGTH = {"event_id": 255, "device_id": 100, "event_type": 50, "source_api": 100}
REQUIRED = ("event_id", "device_id", "event_type", "timestamp")

# Event types the staging model accepts.
EVENT_TYPES = ("page_view", "button_click", "api_call", "error")

# Fixed value: first instant that staging keeps.
EARLIEST = "2024-01-01 00:00:00"

# metric_value is exact: 20 integer and 18 fractional digits.
METRIC = T.DecimalType(38, 18)

RAW = T.StructType(
    [
        T.StructField("event_id", T.StringType(), False),
        T.StructField("device_id", T.StringType(), False),
        T.StructField("event_type", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("payload", T.VariantType(), True),
        T.StructField("source_api", T.StringType(), True),
        T.StructField("ingestion_timestamp", T.TimestampType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)

# Columns the database fills in when an insert leaves them out.
RAW_DEFAULTS = {"ingestion_timestamp": "CURRENT_TIMESTAMP", "created_at": "CURRENT_TIMESTAMP"}

STAGING = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        *[T.StructField(name, T.StringType()) for name in TEXT_KEYS],
        T.StructField("metric_value", METRIC),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("raw_payload", T.VariantType()),
        T.StructField("source_api", T.StringType()),
    ]
)

GRAIN = ("device_id", "metric_date", "event_type")

FACT = T.StructType(
    [
        T.StructField("metric_id", T.StringType()),
        T.StructField("device_id", T.StringType()),
        T.StructField("metric_date", T.DateType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("device_model", T.StringType()),
        T.StructField("os_version", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("event_count", T.LongType()),
        T.StructField("unique_sessions", T.LongType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("first_event_time", T.TimestampType()),
        T.StructField("last_event_time", T.TimestampType()),
        T.StructField("avg_duration_ms", T.DoubleType()),
        T.StructField("total_duration_ms", T.LongType()),
        T.StructField("avg_metric_value", METRIC),
        T.StructField("total_metric_value", METRIC),
        T.StructField("dbt_updated_at", T.TimestampType()),
    ]
)

DIMENSION = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("device_model", T.StringType()),
        T.StructField("os_version", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("first_seen_at", T.TimestampType()),
        T.StructField("last_seen_at", T.TimestampType()),
        T.StructField("total_events", T.LongType()),
        T.StructField("active_days", T.LongType()),
        T.StructField("days_active_span", T.IntegerType()),
        T.StructField("dbt_updated_at", T.TimestampType()),
    ]
)

# One row per device and day: what the dimension needs of that day.
DEVICE_DAYS = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("metric_date", T.DateType()),
        T.StructField("events", T.LongType()),
        T.StructField("first_event_time", T.TimestampType()),
        T.StructField(
            "latest",
            T.StructType(
                [
                    T.StructField("event_timestamp", T.TimestampType()),
                    T.StructField("event_id", T.StringType()),
                    T.StructField("device_model", T.StringType()),
                    T.StructField("os_version", T.StringType()),
                    T.StructField("country", T.StringType()),
                ]
            ),
        ),
    ]
)
