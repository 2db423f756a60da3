"""The streamed fact: late, repeated, corrected and future events."""

from datetime import datetime, timedelta

from drumlin.plans import feed, load, refresh
from drumlin.plans.fact import fact_daily
from drumlin.plans.staging import stage
from drumlin.sources import tables
from drumlin.streaming import fact as stream
from tests.helpers import event
from tests.test_feed import plain, put


def day(n, hour=0):
    return f"2024-02-{n:02d}T{hour:02d}:00:00Z"


def test_late_and_repeated_batches(spark, folder):
    layout = refresh.Layout(folder)
    first = [event("a", timestamp=day(1)), event("b", timestamp=day(1, 5), session_id="s", duration_ms=3)]
    steps = [
        (first, 0),
        ([event("c", timestamp=day(4)), event("d", timestamp=day(6, 9))], 0),
        (first, 0),  # the same again: no change
        ([event("e", timestamp=day(1, 2)), event("a", timestamp=day(4, 1), metric_value=2)], 3),  # late: the 1st is closed
        ([event("f", timestamp=day(6, 10)), event("g", timestamp=day(20))], 0),  # one is in the future
    ]
    for i, (batch, late) in enumerate(steps):
        now = datetime(2024, 2, 7, i)
        put(spark, layout.raw, batch, now)
        feed.record(spark, layout.raw)
        assert stream.advance(spark, layout, f"{folder}/checkpoint", now) == late
        want = fact_daily(stage(load.read_raw(spark, layout.raw), now))
        assert plain(stream.read_fact(spark, layout)) == plain(want)
    # State is kept for open days only, and the correction layer has the closed ones.
    layer = {d for d, _ in tables.latest(spark, stream.corrections_root(layout)).parts}
    assert layer == {"2024-02-01", "2024-02-04"}
    before = tables.latest(spark, stream.fact_root(layout)).parts
    assert stream.advance(spark, layout, f"{folder}/checkpoint", datetime(2024, 2, 7, 9)) == 0
    assert tables.latest(spark, stream.fact_root(layout)).parts == before
    # The event of the future comes in when its time has come, without a load.
    later = datetime(2024, 2, 21)
    assert stream.advance(spark, layout, f"{folder}/checkpoint", later) == 1
    assert plain(stream.read_fact(spark, layout)) == plain(fact_daily(stage(load.read_raw(spark, layout.raw), later)))


def test_watermark_ignores_clocks_that_are_ahead(spark, folder):
    layout = refresh.Layout(folder)
    put(spark, layout.raw, [event("x", timestamp="2031-01-01T00:00:00Z"), event("a", timestamp=day(3))], datetime(2024, 2, 4))
    put(spark, layout.raw, [event("b", timestamp=day(2))], datetime(2024, 2, 5))
    feed.record(spark, layout.raw)
    marks = stream.watermarks(feed.read(spark, layout.raw), timedelta(days=1))
    assert list(marks) == [1, 2] and marks[2].startswith("2024-02-02 00:00:00")


def test_state_holds_open_days_and_sums_taken_back_are_none(spark, folder):
    layout = refresh.Layout(folder)
    many = [event(f"m{i}", timestamp=day(1 + i % 6, i), metric_value=i) for i in range(12)]
    steps = [
        many,  # of the six days the load itself closes four
        [event("m0", timestamp=day(1), metric_value=None), event("m5", timestamp=day(6, 5), metric_value=None)],
    ]
    for i, batch in enumerate(steps):
        now = datetime(2024, 2, 7, i)
        put(spark, layout.raw, batch, now)
        feed.record(spark, layout.raw)
        stream.advance(spark, layout, f"{folder}/checkpoint", now)
        want = fact_daily(stage(load.read_raw(spark, layout.raw), now))
        assert plain(stream.read_fact(spark, layout)) == plain(want)
    state = spark.read.format("statestore").option("batchId", 0).load(f"{folder}/checkpoint")
    days = {row.day.isoformat() for row in state.select("key.metric_date").withColumnRenamed("metric_date", "day").collect()}
    assert days == {"2024-02-05", "2024-02-06"}


def test_totals_of_a_batch_are_made_once(spark, folder, monkeypatch):
    layout = refresh.Layout(folder)
    put(spark, layout.raw, [event("a", timestamp=day(3))], datetime(2024, 2, 4))
    feed.record(spark, layout.raw)
    made = spark.sparkContext.accumulator(0)
    stateful = stream._stateful

    def counted(dated):
        def see(batches):
            for batch in batches:
                made.add(batch.num_rows)
                yield batch

        totals = stateful(dated)
        return totals.mapInArrow(see, totals.schema)

    monkeypatch.setattr(stream, "_stateful", counted)
    stream.advance(spark, layout, f"{folder}/checkpoint", datetime(2024, 2, 4))
    assert made.value == 1
