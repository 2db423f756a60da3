"""The physical plans are the ones the design relies on."""

import pytest

from drumlin.operators.upsert import UPDATE, upsert
from drumlin.plans.dimension import device_days, dim_devices
from drumlin.plans.fact import fact_daily
from drumlin.plans.load import load_rows, read_raw
from drumlin.plans.refresh import on_dates
from drumlin.plans.staging import stage
from drumlin.sources import pages as P
from tests.helpers import AS_OF, LOAD_TS, event, pages, raw


@pytest.fixture(scope="module", autouse=True)
def whole_plans(spark):
    """Print pushed filters in full."""
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    payload = '{"device_model": "m", "city": "c", "user_id": "u", "duration_ms": 1}'
    rows = [(f"e{i}", "d", "t", "2024-02-01 00:00:00", payload) for i in range(50)]
    load_rows(spark, raw(spark, rows), root, order=["event_id"], load_ts=LOAD_TS)
    return read_raw(spark, root)


def test_fact(stored):
    text = plan(fact_daily(stage(stored, AS_OF), AS_OF))
    assert text.count("Exchange hashpartitioning") == 3
    for slow in ("Expand", "ObjectHashAggregate", "Python", "collect_set", "Join"):
        assert slow not in text
    # Only the keys the fact needs leave the file, and the time bounds reach the scan.
    assert "payload:struct<" in text and "source_api" not in text
    assert "GreaterThanOrEqual(timestamp" in text


def test_dimension(stored):
    for df in (dim_devices(stage(stored, AS_OF), AS_OF), device_days(stage(stored, AS_OF))):
        text = plan(df)
        assert text.count("Exchange hashpartitioning") == 1
        assert "partial_max_by" in text and "Window" not in text and "Python" not in text


def test_staging_of_few_days_prunes(stored):
    text = plan(stage(on_dates(stored, "timestamp", ["2024-02-01", "2024-02-03"]), AS_OF))
    assert "GreaterThanOrEqual(timestamp,2024-02-01" in text
    assert "LessThan(timestamp,2024-02-04" in text


def test_pages_are_parsed_once(spark):
    assert optimized(P.events(pages(spark, [event()]))).count("parseJson") == 1


def test_upsert_combines_before_its_shuffle(stored):
    batch = stored.drop("created_at")
    old = stored.drop("created_at")
    text = plan(upsert(old, batch, key="event_id", update=UPDATE, order=["timestamp"]))
    assert "partial_max_by" in text and "partial_min_by" in text
    assert "Window" not in text and "Cartesian" not in text
