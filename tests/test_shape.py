from datetime import datetime

import pytest
from pyspark.sql import functions as F

from drumlin.operators.shape import shape, violations
from drumlin.sources.pages import PAGES, events
from tests.helpers import SOURCE, WINDOW, event, pages


def shaped(spark, *batch):
    return shape(events(pages(spark, list(batch))), SOURCE)


def one(spark, **changed):
    return shaped(spark, event(**changed)).withColumn("payload", F.to_json("payload")).first()


def rules(spark, **changed):
    found = violations(shaped(spark, event("good"), event(**changed)))
    return {row.rule: row["rows"] for row in found.collect()}


def test_source_default_only_if_absent(spark):
    assert one(spark).source_api == SOURCE
    assert one(spark, source_api=None).source_api is None
    assert one(spark, source_api="app").source_api == "app"


def test_ingestion_timestamp_has_no_default(spark):
    assert one(spark).ingestion_timestamp is None
    got = one(spark, ingestion_timestamp="2024-02-01T13:00:00+01:00").ingestion_timestamp
    assert got == datetime(2024, 2, 1, 12)


def test_payload_keeps_every_other_key_with_its_type(spark):
    row = one(spark, n=1.25, s="1", nested={"b": [1, None]}, none=None, created_at="x", flag=True)
    assert row.payload == (
        '{"created_at":"x","flag":true,"n":1.25,"nested":{"b":[1,null]},"none":null,"s":"1"}'
    )
    assert one(spark).payload == "{}"


def test_exact_numbers_and_last_duplicate_key(spark):
    text = '{"data":[{"event_id":"e","x":12345678901234567890.123456789012345678,"k":1,"k":2}]}'
    df = spark.createDataFrame([(*WINDOW, 1, text)], PAGES)
    row = shape(events(df), SOURCE).select(F.to_json("payload").alias("p")).first()
    assert row.p == '{"k":2,"x":12345678901234567890.123456789012345678}'


def test_scalars_become_text(spark):
    row = one(spark, event_id=12, device_id=True)
    assert (row.event_id, row.device_id, row.violations) == ("12", "true", "")


@pytest.mark.parametrize(
    "changed, rule",
    [
        ({"event_id": None}, "event_id_missing"),
        ({"device_id": ...}, "device_id_missing"),
        ({"event_type": None}, "event_type_missing"),
        ({"timestamp": ...}, "timestamp_missing"),
        ({"event_id": "x" * 256}, "event_id_too_long"),
        ({"device_id": "x" * 101}, "device_id_too_long"),
        ({"event_type": "x" * 51}, "event_type_too_long"),
        ({"source_api": "x" * 101}, "source_api_too_long"),
        ({"timestamp": "nope"}, "timestamp_unreadable"),
        ({"timestamp": "12:00"}, "timestamp_unreadable"),
        ({"timestamp": "2024"}, "timestamp_unreadable"),
        ({"timestamp": 1706788800}, "timestamp_unreadable"),
        ({"ingestion_timestamp": "2024-02-30"}, "ingestion_timestamp_unreadable"),
        ({"device_id": {"a": 1}}, "device_id_nested"),
        ({"event_type": ["a"]}, "event_type_nested"),
    ],
)
def test_each_rule(spark, changed, rule):
    assert rules(spark, **changed) == {rule: 1}


def test_limits_are_inclusive(spark):
    assert rules(spark, event_id="é" * 255, device_id="x" * 100, event_type="x" * 50) == {}
    assert rules(spark, device_id="{not json", timestamp="2024-02-01 10:00:00+00") == {}
