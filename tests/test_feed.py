"""Key index, change feed, point in time and the fact kept by deltas."""

import random
from datetime import datetime, timedelta

import pytest

from drumlin.contract import GRAIN
from drumlin.operators import changes
from drumlin.operators.changes import compare, last_images
from drumlin.operators.deltas import corrected, signed_counts
from drumlin.operators.upsert import IGNORE, NARROW, UPDATE
from drumlin.plans import fact_state, feed, key_index, load, refresh
from drumlin.plans.fact import fact_daily
from drumlin.plans.staging import stage
from drumlin.sources import tables
from tests.helpers import LOAD_TS, SOURCE, event, pages, shown

DAYS = [LOAD_TS + timedelta(days=i) for i in range(6)]


def put(spark, root, batch, when, update=UPDATE):
    return load.load_pages(spark, pages(spark, batch), root, default_source=SOURCE, load_ts=when, update=update)


def ids(seed, n):
    numbers = random.Random(seed)
    return [f"{numbers.getrandbits(64):016x}" for _ in range(n)]


def keys(spark, found):
    return spark.createDataFrame([(x,) for x in found], "event_id string")


def plain(df):
    return sorted((tuple(r) for r in df.drop("dbt_updated_at").collect()), key=repr)


def test_random_ids_skip_partitions(spark, folder):
    sets = [ids(i, 40) for i in range(4)]
    for when, found in zip(DAYS, sets, strict=False):
        put(spark, folder, [event(x) for x in found], when)
    before = tables.latest(spark, folder)
    batch = keys(spark, [sets[2][7], sets[2][9], *ids(99, 30)])
    assert key_index.dates_of(spark, folder, before, batch) == ["2024-02-05"]
    hits = load.matched(spark, folder, before, batch)
    assert sorted(r.event_id for r in hits.collect()) == sorted([sets[2][7], sets[2][9]])
    # The plan reads the folder of that day alone, though its ids span the range of all others.
    own = [f for f in hits.inputFiles() if "created_date=" in f]
    assert own and all("created_date=2024-02-05" in f for f in own)
    # New ids alone read no partition at all, and no more than their buckets of the index.
    new = keys(spark, ids(7, 1))
    assert not [f for f in load.matched(spark, folder, before, new).inputFiles() if "created_date=" in f]
    files = key_index._found(spark, folder, before, new).inputFiles()
    assert len({f.split("bucket=")[1].split("/")[0] for f in files}) <= 1


def test_index_is_rebuilt_and_merged(spark, folder, monkeypatch):
    monkeypatch.setattr(key_index, "MOST_PARTS", 3)
    for i, when in enumerate(DAYS):
        put(spark, folder, [event(x) for x in ids(i, 30)], when)
    index = tables.latest(spark, key_index.root_of(folder))
    counts = [sum(b == bucket for b, _ in index.parts) for bucket, _ in index.parts]
    assert max(counts) < 3
    rows = tables.read(spark, key_index.root_of(folder), key_index.INDEX, index.parts, key_index.PARTITION)
    assert rows.count() == rows.distinct().count() == 180
    # An index that does not cover the table is not trusted: one that says so little is built again.
    tables.publish(spark, key_index.root_of(folder), [], {key_index.COVERS: "1"})
    put(spark, folder, [event(ids(0, 1)[0], event_type="error")], DAYS[5])
    assert load.read_raw(spark, folder).count() == 180


def test_index_of_a_load_that_failed(spark, folder):
    """The index names a key that never came to the table: it is still new."""
    put(spark, folder, [event("a")], DAYS[0])
    before = tables.latest(spark, folder)
    ghost = spark.createDataFrame([("g", DAYS[0].date())], "event_id string, created_date date")
    key_index.extend(spark, folder, before, ghost)
    summary = put(spark, folder, [event("g"), event("a")], DAYS[1])
    assert (summary.inserted, summary.updated) == (1, 1)
    assert load.read_raw(spark, folder).count() == 2


def test_compare(spark):
    columns = "k string, a int, b string, p variant"

    def frame(rows):
        text = spark.createDataFrame(rows, "k string, a int, b string, p string")
        return text.selectExpr("k", "a", "b", "parse_json(p) as p")

    old = frame([("same", 1, None, '{"x":1,"y":2}'), ("null", None, "1", None), ("gone", 1, "b", "{}"), ("new", 2, "b", "{}"), ("p", 1, "b", '{"x":1}')])
    new = frame([("same", 1, None, '{"y":2,"x":1}'), ("null", 1, None, None), ("come", 1, "b", "{}"), ("new", 3, "b", "{}"), ("p", 1, "b", '{"x":2}')])
    assert new.dtypes == [tuple(c.split()) for c in columns.split(", ")]
    found = {r.k: (r.op, r.old and r.old.a, r.new and r.new.a) for r in compare(old, new, "k").collect()}
    assert found == {
        "null": ("update", None, 1), "gone": ("delete", 1, None), "come": ("insert", None, 1), "new": ("update", 2, 3), "p": ("update", 1, 1)
    }
    assert compare(old.limit(0), new.limit(0), "k").count() == 0


def test_feed_reads_changed_partitions_only(spark, folder):
    put(spark, folder, [event("a"), event("b")], DAYS[0])
    put(spark, folder, [event("c")], DAYS[1])
    assert feed.record(spark, folder) == 2
    put(spark, folder, [event("c", x=2), event("d")], DAYS[2])
    versions = tables.versions_since(spark, folder, 1)
    changes = feed.between(spark, folder, *versions)
    assert not any("created_date=2024-02-03" in f for f in changes.inputFiles())
    assert feed.record(spark, folder) == 3 == feed.record(spark, folder)
    rows = sorted((r.load, r.op, r.event_id, r.old is None) for r in feed.read(spark, folder).collect())
    assert rows == [(1, "insert", "a", True), (1, "insert", "b", True), (2, "insert", "c", True), (3, "insert", "d", True), (3, "update", "c", False)]


def test_point_in_time(spark, folder):
    kept = {}
    steps = [
        ([event("a", x=1), event("b")], UPDATE), ([event("a", x=2), event("c")], UPDATE),
        ([event("b", event_type="error"), event("d")], NARROW), ([event("a", x=9), event("e")], IGNORE),
    ]
    for when, (batch, update) in zip(DAYS, steps, strict=False):
        put(spark, folder, batch, when, update)
        feed.record(spark, folder)
        kept[when] = shown(load.read_raw(spark, folder))
    for when, want in kept.items():
        assert shown(feed.raw_as_of(spark, folder, when)) == want
        assert shown(feed.raw_as_of(spark, folder, when + timedelta(hours=5))) == want
    assert feed.raw_as_of(spark, folder, DAYS[0] - timedelta(seconds=1)).count() == 0
    # Every version is kept as long as it is not recorded; one that is gone is an error, not a gap.
    gone = spark.createDataFrame([("a", "delete", 9)], "event_id string, op string, load int").selectExpr(
        "event_id", "op", "cast(null as struct<x:int>) as new", "load"
    )
    assert last_images(gone, "event_id", "load").count() == 0


def random_batch(numbers, step):
    day = lambda: f"2024-02-{numbers.randint(1, 6):02d}T{numbers.randint(0, 23):02d}:00:00Z"
    return [
        event(
            f"e{numbers.randint(0, 25)}", device_id=f"d{numbers.randint(0, 2)}", timestamp=day(),
            event_type=numbers.choice(["error", "page_view"]), session_id=numbers.choice(["s", "t", None]),
            user_id=numbers.choice(["u", "v", ...]), device_model=numbers.choice(["m", "n"]), country=numbers.choice(["x", "y", None]),
            duration_ms=numbers.choice([5, 7, ...]), metric_value=numbers.choice([1.5, -2, ...]),
        )
        for _ in range(numbers.randint(1, 15))
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_fact_by_deltas_equals_a_build(spark, folder, seed):
    """Random loads that move, correct and repeat events, some of them in the future."""
    numbers, layout = random.Random(seed), refresh.Layout(folder)
    clock = datetime(2024, 2, 2)
    for step in range(4):
        put(spark, layout.raw, random_batch(numbers, step), DAYS[step])
        feed.record(spark, layout.raw)
        clock += timedelta(hours=numbers.choice([0, 20, 40]))
        fact_state.apply(spark, layout, clock)
        want = fact_daily(stage(load.read_raw(spark, layout.raw), clock), clock)
        assert plain(fact_state.read_fact(spark, layout)) == plain(want)
    with pytest.raises(fact_state.ClockMovedBack):
        fact_state.apply(spark, layout, clock - timedelta(hours=1))
    fact_state.apply(spark, layout, datetime(2024, 3, 1))  # what was in the future comes in without a load
    want = fact_daily(stage(load.read_raw(spark, layout.raw), datetime(2024, 3, 1)))
    assert plain(fact_state.read_fact(spark, layout)) == plain(want)


def test_deltas_do_not_read_raw(spark, folder):
    layout = refresh.Layout(folder)
    put(spark, layout.raw, [event("a"), event("b", timestamp="2024-02-02T01:00:00Z")], DAYS[0])
    feed.record(spark, layout.raw)
    fact_state.apply(spark, layout, DAYS[5])
    first = dict(tables.latest(spark, fact_state.counts_root(layout)).parts)
    put(spark, layout.raw, [event("a", session_id="s")], DAYS[1])
    feed.record(spark, layout.raw)
    old = tables.latest(spark, fact_state.counts_root(layout))
    signed = fact_state.signed_images(feed.read(spark, layout.raw, after=1))
    counts = fact_state.changed_counts(spark, layout, old, signed, DAYS[5], ["2024-02-01"])
    files = counts.inputFiles()
    assert files and not any("/telemetry_events/data/" in f for f in files)
    assert not any("metric_date=2024-02-02" in f for f in files)
    assert fact_state.apply(spark, layout, DAYS[5]).days == ("2024-02-01",)
    after = dict(tables.latest(spark, fact_state.counts_root(layout)).parts)
    assert after["2024-02-02"] == first["2024-02-02"] and after["2024-02-01"] != first["2024-02-01"]


def test_a_change_applied_twice_raises(spark, folder):
    layout = refresh.Layout(folder)
    put(spark, layout.raw, [event("a")], DAYS[0])
    feed.record(spark, layout.raw)
    signed = fact_state.signed_images(feed.read(spark, layout.raw))
    rows = fact_state.staged_signed(signed, DAYS[5]).selectExpr("*", "to_date(event_timestamp) as metric_date")
    counts = signed_counts(rows, GRAIN)
    minus = signed_counts(rows.withColumn("sign", -rows["sign"]), GRAIN)
    assert corrected(counts, minus, GRAIN).count() == 0
    with pytest.raises(Exception, match="below zero"):
        corrected(counts, minus.unionByName(minus), GRAIN).collect()


def test_first_load_is_all_inserts(spark):
    """As a comparison with no rows, a NULL key included, but without a join."""
    new = spark.createDataFrame([("a", 1, None), ("b", None, "x"), (None, 2, "y")], "k string, n int, t string")
    found = changes.inserts(new, "k")
    want = changes.compare(new.where("false"), new, "k")
    assert found.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
