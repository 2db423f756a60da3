"""Device history: ranges without gaps or overlaps, spliced by events that come late."""

from datetime import datetime

from drumlin.plans import feed, history, refresh
from drumlin.sources import tables
from tests.helpers import event
from tests.test_feed import put

NOW = datetime(2024, 2, 20)


def seen(name, when, model="m", **more):
    return event(name, timestamp=f"2024-02-{when}:00Z", device_model=model, **more)


def ranges(rows):
    found = sorted(rows.collect(), key=lambda r: (r.device_id, r.version))
    for a, b in zip(found, found[1:], strict=False):
        if a.device_id == b.device_id:
            assert a.valid_to == b.valid_from > a.valid_from and not a.is_current and b.version == a.version + 1
            assert (a.device_model, a.os_version, a.country) != (b.device_model, b.os_version, b.country)
        else:
            assert a.is_current and a.valid_to is None and b.version == 1
    assert not found or found[-1].is_current
    return [(r.device_id, r.device_model, r.valid_from.strftime("%dT%H:%M")) for r in found]


def test_late_event_splits_a_range(spark, folder):
    layout = refresh.Layout(folder)
    put(spark, layout.raw, [seen("a", "01T10:00"), seen("b", "01T10:30"), seen("c", "03T12:00"), seen("d", "05T01:00", "n"),
                            seen("x", "02T01:00", "q", device_id="d2")], NOW)
    feed.record(spark, layout.raw)
    history.refresh(spark, layout, NOW)
    assert ranges(history.read_history(spark, layout)) == [("d1", "m", "01T10:00"), ("d1", "n", "05T01:00"), ("d2", "q", "02T01:00")]
    before = dict(tables.latest(spark, history.runs_root(layout)).parts)
    # In the middle of a range: it is split, and goes on at the next event that was seen.
    put(spark, layout.raw, [seen("late", "01T10:15", "n")], NOW)
    feed.record(spark, layout.raw)
    assert history.refresh(spark, layout, NOW) == ["2024-02-01"]
    assert ranges(history.read_history(spark, layout)) == [
        ("d1", "m", "01T10:00"), ("d1", "n", "01T10:15"), ("d1", "m", "01T10:30"), ("d1", "n", "05T01:00"), ("d2", "q", "02T01:00")
    ]
    after = dict(tables.latest(spark, history.runs_root(layout)).parts)
    assert {d for d in after if after[d] != before.get(d)} == {"2024-02-01"}
    # The late event is corrected and the one that ended the range moves: two ranges become one again.
    put(spark, layout.raw, [seen("late", "01T10:15"), seen("d", "01T09:00", "n")], NOW)
    feed.record(spark, layout.raw)
    history.refresh(spark, layout, NOW)
    assert ranges(history.read_history(spark, layout)) == [("d1", "n", "01T09:00"), ("d1", "m", "01T10:00"), ("d2", "q", "02T01:00")]


def test_one_instant_and_nulls(spark, folder):
    layout = refresh.Layout(folder)
    put(spark, layout.raw, [seen("a", "01T10:00", None), seen("b", "01T10:00", "p"), seen("c", "01T11:00", None), seen("d", "01T12:00", ...),
                            seen("f", "25T00:00", "z")], NOW)
    feed.record(spark, layout.raw)
    history.refresh(spark, layout, NOW)
    assert ranges(history.read_history(spark, layout)) == [("d1", "p", "01T10:00"), ("d1", None, "01T11:00")]
    history.refresh(spark, layout, datetime(2024, 2, 26))  # its time has come
    assert ranges(history.read_history(spark, layout))[-1] == ("d1", "z", "25T00:00")
