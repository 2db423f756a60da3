"""Small builders for hand-written batches."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from drumlin.sources.pages import PAGES

WINDOW = ("2024-02-01T00:00:00", "2024-02-02T00:00:00")
LOAD_TS = datetime(2024, 2, 3)
AS_OF = datetime(2024, 6, 1)
SOURCE = "https://api.example.com"


def event(event_id="e1", **changed):
    """An event as a dict; a value of ``...`` drops the key."""
    base = {
        "event_id": event_id,
        "device_id": "d1",
        "event_type": "page_view",
        "timestamp": "2024-02-01T12:00:00Z",
        **changed,
    }
    return {k: v for k, v in base.items() if v is not ...}


def pages(spark, *batches, window=WINDOW):
    """One page per list of events; the last page closes the pull."""
    rows = []
    for number, batch in enumerate(batches, start=1):
        document = {"data": batch, "pagination": {"has_more": number < len(batches)}}
        rows.append((*window, number, json.dumps(document)))
    return spark.createDataFrame(rows, PAGES)


def raw(spark, rows):
    """Raw rows from (event_id, device_id, event_type, timestamp, payload JSON)."""
    columns = "event_id string, device_id string, event_type string, timestamp string, payload string"
    return spark.createDataFrame(rows, columns).select(
        "event_id",
        "device_id",
        "event_type",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        F.parse_json("payload").alias("payload"),
        F.lit("test").alias("source_api"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("ingestion_timestamp"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("created_at"),
    )


def shown(raw_rows):
    """Raw rows as dicts with the payload as JSON text, by event id."""
    rows = raw_rows.withColumn("payload", F.to_json("payload")).collect()
    return {row.event_id: row.asDict() for row in rows}
