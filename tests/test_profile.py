from datetime import datetime

from pyspark.sql import functions as F

from drumlin.contract import RAW, RAW_DEFAULTS
from drumlin.operators import profile
from tests.helpers import raw


def test_row_counts(spark):
    counts = profile.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {r.table_name: r.row_count for r in counts.collect()} == {"a": 3, "b": 0}


def test_column_profile(spark):
    rows = profile.column_profile(spark, RAW, RAW_DEFAULTS).orderBy("ordinal_position").collect()
    assert [r.name for r in rows] == RAW.names
    assert tuple(rows[0])[1:] == ("event_id", "string", False, None)
    assert tuple(rows[7])[1:] == ("created_at", "timestamp", True, "CURRENT_TIMESTAMP")


def test_column_fill(spark):
    rows = profile.column_fill(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"))
    assert {r.name: (r.row_count, r.null_count) for r in rows.collect()} == {"a": (2, 0), "b": (2, 1)}


def test_freshness(spark):
    rows = raw(spark, [("a", "d", "t", "2024-02-01 00:00:00", "{}")])
    found = profile.freshness(rows, datetime(2024, 2, 1, 0, 59)).first()
    assert tuple(found) == (1, datetime(2024, 2, 1))
    assert tuple(profile.freshness(rows, datetime(2024, 2, 1, 1)).first()) == (0, None)


def test_today(spark):
    facts = spark.createDataFrame(
        [("a", "2024-02-01", 1.0), ("a", "2024-02-01", None), ("a", "2024-01-31", 9.0)],
        "event_type string, metric_date string, avg_duration_ms double",
    ).withColumn("metric_date", F.col("metric_date").cast("date"))
    (row,) = profile.daily_type_summary(facts, datetime(2024, 2, 1, 23)).collect()
    assert tuple(row) == ("a", 2, 1.0)


def test_load_check(spark):
    rows = raw(spark, [("a", "d", "t", "2024-02-01 00:00:00", "{}")])
    assert tuple(profile.load_check(rows, "test", "ok").first()) == ("ok", 1)
    assert tuple(profile.load_check(rows, "none", "ok").first()) == ("ok", 0)
