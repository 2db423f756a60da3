import random
from datetime import datetime

import pytest

from drumlin.plans import refresh
from drumlin.plans.dimension import dim_devices
from drumlin.plans.fact import fact_daily
from drumlin.plans.load import load_pages, read_raw
from drumlin.plans.staging import stage
from drumlin.sources import tables
from tests.helpers import SOURCE, event, pages


def load(spark, layout, batch, load_ts):
    return load_pages(
        spark, pages(spark, batch), layout.raw, default_source=SOURCE, load_ts=load_ts
    )


def rebuild(spark, layout, as_of):
    refresh.publish(spark, layout, refresh.build(spark, layout, as_of))


def assert_fresh(spark, layout, as_of):
    """The refreshed marts equal marts built from nothing; run times aside."""
    staging = stage(read_raw(spark, layout.raw), as_of)

    def rows(df):
        return sorted((tuple(r) for r in df.drop("dbt_updated_at").collect()), key=repr)

    assert rows(refresh.read_fact(spark, layout)) == rows(fact_daily(staging, as_of))
    assert rows(refresh.read_devices(spark, layout)) == rows(dim_devices(staging, as_of))


def at(day, hour=0):
    return f"2024-02-{day:02d}T{hour:02d}:00:00Z"


def test_moved_event(spark, folder):
    layout, now = refresh.Layout(folder), datetime(2024, 2, 20)
    load(spark, layout, [event("a", timestamp=at(1)), event("b", timestamp=at(3))], now)
    rebuild(spark, layout, now)
    load(spark, layout, [event("a", timestamp=at(5), device_id="d2")], now)
    before = dict(tables.latest(spark, layout.fact).parts)
    rebuild(spark, layout, now)
    after = dict(tables.latest(spark, layout.fact).parts)
    assert sorted(after) == ["2024-02-03", "2024-02-05"]  # the old day is empty now
    assert after["2024-02-03"] == before["2024-02-03"]
    assert_fresh(spark, layout, now)


def test_future_event_comes_in_without_a_load(spark, folder):
    layout = refresh.Layout(folder)
    load(spark, layout, [event("a", timestamp=at(1)), event("f", timestamp=at(9))], datetime(2024, 2, 2))
    rebuild(spark, layout, datetime(2024, 2, 2))
    assert refresh.read_fact(spark, layout).count() == 1
    rebuild(spark, layout, datetime(2024, 2, 10))
    assert refresh.read_fact(spark, layout).count() == 2
    assert_fresh(spark, layout, datetime(2024, 2, 10))
    rebuild(spark, layout, datetime(2024, 2, 5))  # and goes again if the clock is set back
    assert_fresh(spark, layout, datetime(2024, 2, 5))


def test_random_batches(spark, folder):
    layout, dice = refresh.Layout(folder), random.Random(7)
    for step in range(4):
        batch = [
            event(
                f"e{dice.randrange(60)}",
                device_id=f"d{dice.randrange(6)}",
                event_type=dice.choice(["page_view", "error"]),
                timestamp=at(dice.randrange(1, 25), dice.randrange(24)),
                session_id=f"s{dice.randrange(5)}",
                country=dice.choice(["NL", "DE", None]),
                duration_ms=dice.randrange(1000),
            )
            for _ in range(40)
        ]
        now = datetime(2024, 2, 12 + step)
        load(spark, layout, batch, now)
        rebuild(spark, layout, now)
        assert_fresh(spark, layout, now)


def test_nothing_to_do(spark, folder):
    layout, now = refresh.Layout(folder), datetime(2024, 2, 20)
    load(spark, layout, [event("a")], now)
    rebuild(spark, layout, now)
    parts = tables.latest(spark, layout.fact).parts
    rebuild(spark, layout, now)
    assert tables.latest(spark, layout.fact).parts == parts


def test_version_is_taken_once(spark, folder):
    tables.publish(spark, folder, [])
    row = spark.createDataFrame([(2, [], {})], tables.VERSION)
    row.write.json(f"{folder}/versions/{2:012d}")
    assert tables.publish(spark, folder, []).version == 3
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        row.write.mode("error").json(f"{folder}/versions/{3:012d}")
