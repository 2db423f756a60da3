"""Deliveries of keys through loads, and pages behind the fact against plain Python."""

import hashlib
from datetime import datetime

from drumlin.plans import lineage
from drumlin.plans.load import load_pages, read_raw
from drumlin.plans.staging import stage
from tests.helpers import AS_OF, SOURCE, event, pages

DAY1, DAY2 = datetime(2024, 2, 3), datetime(2024, 2, 4)
NEXT = ("2024-02-02T00:00:00", "2024-02-03T00:00:00")
COLUMNS = ("window_start", "page", "pos")


def load(spark, folder, batches, window, load_ts):
    load_pages(
        spark, pages(spark, *batches, window=window), f"{folder}/raw",
        default_source=SOURCE, load_ts=load_ts, lineage_root=f"{folder}/lineage",
    )


WINDOW = ("2024-02-01T00:00:00", "2024-02-02T00:00:00")


def two_loads(spark, folder):
    load(spark, folder, [[event("a"), event("b")], [event("c"), event("a", x=1)]], WINDOW, DAY1)
    load(spark, folder, [[event("d")], [], [event("a", x=2), event("b", device_id="d2")]], NEXT, DAY2)


def shown(frame):
    return {r.event_id: (r.deliveries, *[tuple(r[end][c] for c in COLUMNS) for end in ("first", "last")]) for r in frame.collect()}


def test_first_and_last_delivery(spark, folder):
    two_loads(spark, folder)
    early, late = WINDOW[0], NEXT[0]
    want = {
        "a": (3, (early, 1, 0), (late, 3, 0)),
        "b": (2, (early, 1, 1), (late, 3, 1)),
        "c": (1, (early, 2, 0), (early, 2, 0)),
        "d": (1, (late, 1, 0), (late, 1, 0)),
    }
    root = f"{folder}/lineage"
    assert shown(lineage.of_keys(spark, root)) == want
    assert shown(lineage.of_keys(spark, root, until=DAY1)) == {
        "a": (2, (early, 1, 0), (early, 2, 1)), "b": (1, (early, 1, 1), (early, 1, 1)), "c": want["c"],
    }
    # The same load once more replaces its own rows.
    load(spark, folder, [[event("d")], [], [event("a", x=2), event("b", device_id="d2")]], NEXT, DAY2)
    assert shown(lineage.of_keys(spark, root)) == want


def digest(*found):
    texts = ["/".join([*window, str(page)]) for window, page in found]
    return sum(int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in texts)


def test_pages_behind_the_fact(spark, folder):
    two_loads(spark, folder)
    staging = stage(read_raw(spark, f"{folder}/raw"), AS_OF)
    keys = lineage.of_keys(spark, f"{folder}/lineage")
    got = {r.device_id: r for r in lineage.fact_lineage(staging, keys).collect()}
    one, two = got["d1"], got["d2"]  # d1 has a, c and d; b moved to d2
    assert (one.events, one.deliveries, one.pages, one.untraced) == (3, 5, 3, 0)
    assert (one.first_window_start, one.first_page, one.last_window_start, one.last_page) == (WINDOW[0], 2, NEXT[0], 3)
    assert one.pages_digest == digest((WINDOW, 2), (NEXT, 1), (NEXT, 3))
    assert (two.events, two.pages, two.pages_digest) == (1, 1, digest((NEXT, 3)))
    first = {r.device_id: r.pages for r in lineage.fact_lineage(staging, keys, "first").collect()}
    assert first == {"d1": 3, "d2": 1}
    listed = {(r.device_id, r.window_start, r.page, r.events) for r in lineage.behind(staging, keys).collect()}
    assert listed == {("d1", WINDOW[0], 2, 1), ("d1", NEXT[0], 1, 1), ("d1", NEXT[0], 3, 1), ("d2", NEXT[0], 3, 1)}


def test_untraced_events_and_none(spark, folder):
    two_loads(spark, folder)
    staging = stage(read_raw(spark, f"{folder}/raw"), AS_OF)
    keys = lineage.of_keys(spark, f"{folder}/lineage").where("event_id <> 'b'")
    row = lineage.fact_lineage(staging.where("device_id = 'd2'"), keys).first()
    assert (row.events, row.untraced, row.pages, row.deliveries, row.pages_digest) == (1, 1, 0, 0, None)
    assert lineage.fact_lineage(staging.limit(0), keys).count() == 0 == lineage.behind(staging.limit(0), keys).count()


def test_no_python_and_no_list(spark, folder):
    two_loads(spark, folder)
    staging = stage(read_raw(spark, f"{folder}/raw"), AS_OF)
    plan = lineage.fact_lineage(staging, lineage.of_keys(spark, f"{folder}/lineage"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "collect_" not in plan
