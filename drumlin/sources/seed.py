"""The three rows a new raw table starts with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.functions.clock import instant

# The seed rows.
SEED_SOURCE = "seed_data"
SEED_STATUS = "Database initialized!"
SEED_ROWS = [
    (
        "evt_seed_001",
        "device_001",
        "page_view",
        "2024-02-01 10:00:00+00",
        '{"device_model": "iPhone 13", "os_version": "iOS 17", "user_id": "user_001",'
        ' "session_id": "session_001", "country": "Netherlands", "city": "Amsterdam",'
        ' "metric_value": 100, "duration_ms": 1500}',
    ),
    (
        "evt_seed_002",
        "device_002",
        "button_click",
        "2024-02-01 11:00:00+00",
        '{"device_model": "Samsung S23", "os_version": "Android 14", "user_id": "user_002",'
        ' "session_id": "session_002", "country": "Germany", "city": "Berlin",'
        ' "metric_value": 75, "duration_ms": 800}',
    ),
    (
        "evt_seed_003",
        "device_003",
        "page_view",
        "2024-02-02 09:00:00+00",
        '{"device_model": "iPhone 14", "os_version": "iOS 17", "user_id": "user_003",'
        ' "session_id": "session_003", "country": "France", "city": "Paris",'
        ' "metric_value": 120, "duration_ms": 2000}',
    ),
]


def seed_rows(spark: SparkSession, load_ts) -> DataFrame:
    """Raw rows of the seed; the column it leaves out takes its default, the load time."""
    columns = "event_id string, device_id string, event_type string, timestamp string, payload string"
    return spark.createDataFrame(SEED_ROWS, columns).select(
        "event_id",
        "device_id",
        "event_type",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.parse_json("payload").alias("payload"),
        F.lit(SEED_SOURCE).alias("source_api"),
        instant(load_ts).alias("ingestion_timestamp"),
    )
