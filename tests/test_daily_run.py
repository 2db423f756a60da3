from datetime import date, datetime

import pytest

from drumlin.operators import quality
from drumlin.operators.profile import load_check
from drumlin.plans import daily_run as D
from drumlin.plans import refresh
from drumlin.plans.load import read_raw
from drumlin.sources import tables
from drumlin.sources.seed import SEED_SOURCE, SEED_STATUS
from tests.helpers import SOURCE, event, pages

NOW = datetime(2024, 2, 20)


def run(spark, layout, batch, as_of=NOW, **options):
    return D.daily_run(
        spark, pages(spark, batch), layout, as_of=as_of, default_source=SOURCE, **options
    )


def test_seed_end_to_end(spark, folder):
    layout = refresh.Layout(folder)
    assert D.initialise(spark, layout, NOW).inserted == 3
    assert D.initialise(spark, layout, datetime(2024, 2, 21)).inserted == 0
    raw = read_raw(spark, layout.raw)
    assert tuple(load_check(raw, SEED_SOURCE, SEED_STATUS).first()) == (SEED_STATUS, 3)
    assert {r.ingestion_timestamp for r in raw.collect()} == {NOW}
    report = run(spark, layout, [])
    assert all(row.passed for row in report.results.collect())
    assert len(report.results.collect()) == 12
    facts = refresh.read_fact(spark, layout).collect()
    assert [r.event_count for r in facts] == [1, 1, 1]
    assert {r.metric_date for r in facts} == {date(2024, 2, 1), date(2024, 2, 2)}
    for row in refresh.read_devices(spark, layout).collect():
        assert (row.total_events, row.active_days, row.days_active_span) == (1, 1, 0)
    D.register_views(spark, layout, NOW)
    staged = spark.sql("select app_version, country from stg_telemetry__raw order by event_id")
    assert [tuple(r) for r in staged.collect()] == [
        (None, "Netherlands"),
        (None, "Germany"),
        (None, "France"),
    ]


def test_repeated_run(spark, folder):
    layout = refresh.Layout(folder)
    batch = [event("a"), event("b", event_type="error"), event("a", device_id="d2")]
    first = run(spark, layout, batch)
    counts = {r.stage: r["rows"] for r in first.counts.collect()}
    assert counts == {
        "read": 3,
        "distinct_keys": 2,
        "inserted": 2,
        "updated": 0,
        quality.RAW: 2,
        quality.STAGING: 2,
        quality.FACT: 2,
        quality.DEVICES: 2,
    }
    facts = sorted(map(tuple, refresh.read_fact(spark, layout).collect()))
    assert run(spark, layout, batch).load.updated == 2
    assert sorted(map(tuple, refresh.read_fact(spark, layout).collect())) == facts


def test_gates(spark, folder):
    layout = refresh.Layout(folder)
    run(spark, layout, [event("a")])
    bad = [event("b", event_type="signup", device_id="d2")]
    with pytest.raises(D.QualityFailed) as error:
        run(spark, layout, bad, gate=D.BEFORE)
    assert error.value.failed == [(quality.STAGING, "event_type", "accepted_values", 1)]
    assert refresh.read_fact(spark, layout).count() == 1  # not published
    with pytest.raises(D.QualityFailed):
        run(spark, layout, bad, gate=D.AFTER)
    assert refresh.read_fact(spark, layout).count() == 2  # published, then tested
    with pytest.raises(ValueError):
        run(spark, layout, bad, gate="never")


def test_referential_rule(spark, folder):
    layout = refresh.Layout(folder)
    report = run(spark, layout, [event("a")], rules=[*quality.RULES, quality.REFERENTIAL])
    assert report.results.count() == 13
    assert tables.latest(spark, layout.devices).version == 1
