import hashlib
import json
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

from drumlin.contract import DIMENSION, FACT
from drumlin.plans.dimension import device_days, dim_devices, from_device_days, latest_attributes
from drumlin.plans.fact import fact_daily
from drumlin.plans.staging import stage
from tests.helpers import AS_OF, raw


def staged(spark, *rows):
    """(event_id, device, type, time, payload dict)"""
    return stage(raw(spark, [(*row[:4], json.dumps(row[4])) for row in rows]), AS_OF)


def fact(spark, *rows):
    return fact_daily(staged(spark, *rows), AS_OF).orderBy("metric_date").collect()


def day(payloads, time="2024-02-01 10:00:00"):
    return [(f"e{i}", "d", "t", time, payload) for i, payload in enumerate(payloads)]


def test_schemas(spark):
    rows = staged(spark, *day([{}]))
    assert fact_daily(rows).schema.simpleString() == FACT.simpleString()
    assert dim_devices(rows).schema.simpleString() == DIMENSION.simpleString()


def test_mode_ties_and_nulls(spark):
    models = ["b", "a", "a", "b", None, None, None]
    (row,) = fact(spark, *day([{"device_model": m, "country": None, "os_version": "x"} for m in models]))
    assert (row.device_model, row.country, row.os_version) == ("a", None, "x")
    assert row.event_count == 7


def test_measures(spark):
    (row,) = fact(
        spark,
        *day(
            [
                {"duration_ms": 1, "metric_value": 0.1, "session_id": "s", "user_id": "u"},
                {"duration_ms": 2, "metric_value": 0.2, "session_id": "s", "user_id": "v"},
                {"session_id": None},
            ]
        ),
    )
    assert (row.avg_duration_ms, row.total_duration_ms) == (1.5, 3)
    assert (row.avg_metric_value, row.total_metric_value) == (Decimal("0.15"), Decimal("0.3"))
    assert (row.event_count, row.unique_sessions, row.unique_users) == (3, 1, 2)
    assert row.metric_id == hashlib.md5(b"d-2024-02-01-t").hexdigest()
    assert row.dbt_updated_at == AS_OF


def test_nothing_measured(spark):
    (row,) = fact(spark, *day([{}, {}]))
    assert (row.avg_duration_ms, row.total_duration_ms) == (None, None)
    assert (row.avg_metric_value, row.total_metric_value) == (None, None)
    assert (row.event_count, row.unique_sessions, row.unique_users) == (2, 0, 0)


def test_large_exact_sum(spark):
    big = Decimal("12345678901234567890.123456789012345678")
    payload = '{"metric_value": %s}' % big
    rows = raw(spark, [("e", "d", "t", "2024-02-01 00:00:00", payload)])
    row = fact_daily(stage(rows, AS_OF), AS_OF).first()
    assert (row.total_metric_value, row.avg_metric_value) == (big, big)


def test_days_split_at_utc_midnight(spark):
    rows = day([{}], "2024-02-01 23:59:59") + [("z", "d", "t", "2024-02-02 00:00:00", {})]
    assert [r.metric_date for r in fact(spark, *rows)] == [date(2024, 2, 1), date(2024, 2, 2)]


def test_latest_event_wins_as_a_whole(spark):
    rows = staged(
        spark,
        ("a", "d", "t", "2024-02-01 10:00:00", {"country": "NL", "device_model": "old"}),
        ("b", "d", "t", "2024-02-01 11:00:00", {"country": "FR", "device_model": "lower id"}),
        ("c", "d", "t", "2024-02-01 11:00:00", {"country": None, "device_model": "new"}),
    )
    for row in (dim_devices(rows).first(), latest_attributes(rows).first()):
        assert (row.device_model, row.country) == ("new", None)


def test_span_counts_whole_days(spark):
    rows = staged(
        spark,
        ("a", "d", "t", "2024-01-30 02:00:00", {}),
        ("b", "d", "t", "2024-03-01 01:00:00", {}),
        ("c", "d", "t", "2024-03-01 00:00:00", {}),
    )
    row = dim_devices(rows, AS_OF).first()
    assert (row.days_active_span, row.active_days, row.total_events) == (30, 2, 3)
    assert row.first_seen_at == datetime(2024, 1, 30, 2)


def test_device_days_give_the_same_dimension(spark):
    rows = staged(
        spark,
        *[
            (f"e{i}", f"d{i % 7}", "t", f"2024-02-{1 + i % 5:02d} {i % 24:02d}:00:00", {"country": str(i)})
            for i in range(200)
        ],
    )
    direct = sorted(map(tuple, dim_devices(rows, AS_OF).collect()))
    assert sorted(map(tuple, from_device_days(device_days(rows), AS_OF).collect())) == direct


def test_hot_group(spark):
    """A third of all events in one group, each with its own session."""
    lines = [
        (
            f"e{i}",
            "hot" if i % 3 == 0 else f"d{i % 50}",
            "t",
            "2024-02-01 10:00:00",
            {"session_id": f"s{i}", "user_id": f"u{i % 11}", "country": "ABC"[i * i % 3], "duration_ms": i},
        )
        for i in range(3000)
    ]
    got = {r.device_id: r for r in fact(spark, *lines)}
    for device in ("hot", "d1", "d49"):
        own = [line[4] for line in lines if line[1] == device]
        row = got[device]
        counts = Counter(p["country"] for p in own)
        best = min(counts, key=lambda c: (-counts[c], c))
        assert row.event_count == row.unique_sessions == len(own)
        assert row.unique_users == len({p["user_id"] for p in own})
        assert (row.country, row.total_duration_ms) == (best, sum(p["duration_ms"] for p in own))
