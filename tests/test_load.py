from datetime import datetime

import pytest

from drumlin.operators.upsert import IGNORE, NARROW
from drumlin.plans.load import IncompletePull, LoadRejected, load_pages, read_raw
from drumlin.sources import tables
from drumlin.sources.pages import PAGES
from tests.helpers import LOAD_TS, SOURCE, WINDOW, event, pages, shown

DAY2 = datetime(2024, 2, 4)


def load(spark, root, *batches, load_ts=LOAD_TS, **options):
    options = {"default_source": SOURCE, **options}
    return load_pages(spark, pages(spark, *batches), root, load_ts=load_ts, **options)


def test_insert_then_update(spark, folder):
    first = load(spark, folder, [event("a", x=1), event("b")], [event("c")])
    assert (first.input_rows, first.distinct_keys, first.inserted, first.updated) == (3, 3, 3, 0)
    assert first.touched_dates == ("2024-02-01",)
    moved = event("a", device_id="d9", timestamp="2024-02-05T00:00:00Z", x=2, source_api="other",
                  ingestion_timestamp="2024-02-06T00:00:00Z")
    second = load(spark, folder, [moved, event("d"), event("d", event_type="error")], load_ts=DAY2)
    assert (second.input_rows, second.distinct_keys, second.inserted, second.updated) == (3, 2, 1, 1)
    # The day the event moved to is after the load's own time.
    assert (second.touched_dates, second.first_later_date) == (("2024-02-01",), "2024-02-05")
    assert first.first_later_date == ""
    rows = shown(read_raw(spark, folder))
    assert sorted(rows) == ["a", "b", "c", "d"]
    a = rows["a"]
    assert (a["device_id"], a["payload"], a["timestamp"]) == ("d9", '{"x":2}', datetime(2024, 2, 5))
    # Columns outside the policy keep their first values.
    assert (a["source_api"], a["ingestion_timestamp"], a["created_at"]) == (SOURCE, None, LOAD_TS)
    assert (rows["d"]["event_type"], rows["d"]["created_at"]) == ("error", DAY2)


def test_same_batch_twice(spark, folder):
    batch = [event("a", x=1), event("a", x=2), event("b")]
    load(spark, folder, batch)
    once = shown(read_raw(spark, folder))
    summary = load(spark, folder, batch, load_ts=DAY2)
    assert (summary.inserted, summary.updated) == (0, 2)
    assert shown(read_raw(spark, folder)) == once


def test_narrow_and_ignore(spark, folder):
    load(spark, folder, [event("a", x=1)])
    load(spark, folder, [event("a", event_type="error", x=2)], update=NARROW)
    row = shown(read_raw(spark, folder))["a"]
    assert (row["event_type"], row["payload"]) == ("page_view", '{"x":2}')
    again = [event("a", x=3), event("b", x=4), event("b", x=5)]
    summary = load(spark, folder, again, update=IGNORE)
    assert (summary.inserted, summary.updated) == (1, 0)
    rows = shown(read_raw(spark, folder))
    assert (rows["a"]["payload"], rows["b"]["payload"]) == ('{"x":2}', '{"x":4}')


def test_untouched_partitions_are_not_rewritten(spark, folder):
    load(spark, folder, [event("a")])
    load(spark, folder, [event("b")], load_ts=DAY2)
    before = tables.latest(spark, folder).parts
    load(spark, folder, [event("b", x=1), event("c")], load_ts=datetime(2024, 2, 5))
    after = tables.latest(spark, folder).parts
    assert [day for day, _ in after] == ["2024-02-03", "2024-02-04", "2024-02-05"]
    assert after[0] == before[0] and after[1] != before[1]


@pytest.mark.parametrize("bad", [{"device_id": ...}, {"event_id": "x" * 256}, {"timestamp": "nope"}])
def test_rejected_batch_changes_nothing(spark, folder, bad):
    load(spark, folder, [event("a")])
    before = shown(read_raw(spark, folder))
    with pytest.raises(LoadRejected) as error:
        load(spark, folder, [event("b"), event(**{"event_id": "c", **bad})])
    assert sum(error.value.rules.values()) == 1
    assert shown(read_raw(spark, folder)) == before
    assert tables.latest(spark, folder).version == 1


def test_incomplete_pull(spark, folder):
    text = '{"data": [], "pagination": {"has_more": true}}'
    cut = spark.createDataFrame([(*WINDOW, 1, text)], PAGES)
    with pytest.raises(IncompletePull):
        load_pages(spark, cut, folder, default_source=SOURCE, load_ts=LOAD_TS)


def test_empty_pull_writes_nothing(spark, folder):
    summary = load(spark, folder, [])
    assert summary.input_rows == 0
    assert tables.latest(spark, folder).version == 0
    assert read_raw(spark, folder).count() == 0


def test_unfinished_version_is_ignored(spark, folder):
    load(spark, folder, [event("a")])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/versions/000000000002")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    assert tables.latest(spark, folder).version == 1
    assert read_raw(spark, folder).count() == 1
    base = tables.latest(spark, folder)
    load(spark, folder, [event("b")])  # goes past the dead writer's number
    assert tables.latest(spark, folder).version == 3
    with pytest.raises(tables.Outdated):
        tables.publish(spark, folder, base.parts, base=base)


def test_remove_unused(spark, folder):
    for step in range(4):
        load(spark, folder, [event("a", x=step), event(f"n{step}")])
    before = shown(read_raw(spark, folder))
    assert len(tables.remove_unused(spark, folder)) == 2
    assert tables.remove_unused(spark, folder) == []
    assert shown(read_raw(spark, folder)) == before
    assert len(before) == 5


def test_scratch_is_left_empty(spark, folder):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    load(spark, folder, [event("a")])
    with pytest.raises(LoadRejected):
        load(spark, folder, [event(device_id=None)])
    assert set(shared.iterdir()) == before
