"""Cases in which a job once lost rows without saying so."""

import json
import os
import subprocess
import sys
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from drumlin.functions import clock
from drumlin.plans import refresh
from drumlin.plans.load import IncompletePull, LoadRejected, load_pages, read_raw
from drumlin.sources import tables
from drumlin.sources.pages import in_window, read_page_files
from drumlin.streaming.load import load_stream, page_table_stream
from tests.helpers import LOAD_TS, SOURCE, event, pages
from tests.test_refresh import assert_fresh, at, load, rebuild


@pytest.mark.parametrize("far", ["12024-01-01T00:00:00Z", "9999-12-31T23:59:59Z", "2031-01-01T00:00:00Z"])
def test_far_off_date_deletes_nothing(spark, folder, far):
    layout, now = refresh.Layout(folder), datetime(2024, 2, 20)
    load(spark, layout, [event("a", timestamp=at(1)), event("b", timestamp=at(1, 2))], now)
    rebuild(spark, layout, now)
    load(spark, layout, [event("c", timestamp=at(1, 3)), event("x", timestamp=far)], now)
    rebuild(spark, layout, now)
    assert refresh.read_fact(spark, layout).agg({"event_count": "sum"}).first()[0] == 3
    assert_fresh(spark, layout, now)


def test_days_after_the_load_are_found_by_a_later_clock(spark, folder):
    """The load's own time is behind the builds' clocks."""
    layout, loaded, now = refresh.Layout(folder), datetime(2024, 2, 2), datetime(2024, 2, 20)
    load(spark, layout, [event("a", timestamp=at(1)), event("b", timestamp=at(9))], loaded)
    rebuild(spark, layout, now)
    load(spark, layout, [event("b", timestamp=at(10)), event("c", timestamp=at(12))], loaded)
    rebuild(spark, layout, now)
    assert_fresh(spark, layout, now)


def test_many_days_reach_the_scan_as_ranges():
    runs = refresh.runs_of_days(["2024-02-03", "2024-02-01", "2024-02-02", "2024-06-01"])
    assert [(str(a), str(b)) for a, b in runs] == [("2024-02-01", "2024-02-04"), ("2024-06-01", "2024-06-02")]


def test_clock_forms():
    want = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)
    east = timezone(timedelta(hours=5))
    for form in (datetime(2024, 2, 1, 12), want, want.astimezone(east), "2024-02-01 12:00:00", "2024-02-01T17:00:00+05:00"):
        assert clock.utc(form) == want and clock.text(form) == clock.text(want)
    assert clock.utc(None).tzinfo is not None


ZONED = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from datetime import datetime
from tests.conftest import new_session
from tests.test_refresh import at, load, rebuild
from tests.helpers import event
from drumlin.plans import daily_run, refresh
from drumlin.plans.load import read_raw
spark = new_session()
layout = refresh.Layout(tempfile.mkdtemp(prefix="zone-"))
daily_run.initialise(spark, layout, datetime(2024, 2, 3))
load(spark, layout, [event("a", timestamp=at(11, 23)), event("b", timestamp=at(12, 3))], datetime(2024, 2, 11))
rebuild(spark, layout, datetime(2024, 2, 11))
rebuild(spark, layout, datetime(2024, 2, 12))
rebuild(spark, layout, datetime(2024, 2, 12, 4))
fact = refresh.read_fact(spark, layout).selectExpr("cast(metric_date as string)", "cast(dbt_updated_at as string)")
raw = read_raw(spark, layout.raw).selectExpr("event_id", "cast(created_at as string)")
print("ROWS", sorted(map(tuple, fact.collect())), sorted(map(tuple, raw.collect())))
"""


def test_drivers_zone_has_no_say():
    repo = str(Path(__file__).resolve().parents[1])
    said = set()
    for zone in ("America/New_York", "Asia/Tokyo"):
        run = subprocess.run(
            [sys.executable, "-c", ZONED.format(repo=repo)],
            env={**os.environ, "TZ": zone}, capture_output=True, text=True, timeout=300,
        )
        said.add(next((x for x in run.stdout.splitlines() if x.startswith("ROWS")), run.stderr[-2000:]))
    assert len(said) == 1
    (line,) = said
    assert "2024-02-12" in line and "2024-02-11 00:00:00" in line


def test_fresh_checkpoint_at_an_old_path_loads_everything(spark, folder):
    landing, root, checkpoint = (f"{folder}/{name}" for name in ("landing", "raw", "checkpoint"))

    def go(where):
        load_stream(page_table_stream(spark, landing), root, where, default_source=SOURCE, load_ts=LOAD_TS)
        return {r.event_id for r in read_raw(spark, root).collect()}

    pages(spark, [event("a")]).write.parquet(landing)
    assert go(checkpoint) == {"a"}
    pages(spark, [event("b")], [event("c")]).write.mode("append").parquet(landing)
    os.rename(checkpoint, f"{checkpoint}-old")  # the stream starts anew at the same path
    assert go(checkpoint) == {"a", "b", "c"}
    assert tables.latest(spark, root).version == 2


def land(landing, start, end, page, batch, more=False):
    target = Path(landing) / f"window_start={start}" / f"window_end={end}"
    target.mkdir(parents=True, exist_ok=True)
    (target / f"page-{page:06d}.json").write_text(json.dumps({"data": batch, "pagination": {"has_more": more}}))


def test_windows(spark, folder):
    landing = f"{folder}/landing"
    land(landing, "2024-02-01T00%3A00%3A00", "2024-02-02T00%3A00%3A00", 1, [event("a")], more=True)
    land(landing, "2024-02-01T00%3A00%3A00", "2024-02-02T00%3A00%3A00", 2, [event("b")])

    def pull(start, end, name):
        window = (start, end)
        arrived = in_window(read_page_files(spark, landing), *window)
        return load_pages(spark, arrived, f"{folder}/{name}", default_source=SOURCE, load_ts=LOAD_TS, window=window)

    assert pull(datetime(2024, 2, 1), datetime(2024, 2, 2), "plain").input_rows == 2
    zoned = datetime(2024, 2, 1, tzinfo=timezone.utc), datetime(2024, 2, 2, 3, tzinfo=timezone(timedelta(hours=3)))
    assert pull(*zoned, "zoned").input_rows == 2
    with pytest.raises(IncompletePull, match="no page"):
        pull(datetime(2024, 2, 2), datetime(2024, 2, 3), "missing")
    assert tables.latest(spark, f"{folder}/missing").version == 0


def test_all_broken_windows_are_counted(spark, folder):
    broken = [pages(spark, [event(f"e{i}")], window=(f"w{i}", f"x{i}")).withColumn("page", F.lit(2)) for i in range(7)]
    arrived = broken[0]
    for more in broken[1:]:
        arrived = arrived.unionByName(more)
    with pytest.raises(IncompletePull, match="7 windows are incomplete, the first is w0..x0"):
        load_pages(spark, arrived, folder, default_source=SOURCE, load_ts=LOAD_TS)


def test_rejected_rows_are_counted(spark, folder):
    batch = [event("a"), event("b", device_id=...), event("c", device_id=..., timestamp="nope"), event("d")]
    with pytest.raises(LoadRejected) as raised:
        load_pages(spark, pages(spark, batch), folder, default_source=SOURCE, load_ts=LOAD_TS)
    assert (raised.value.input_rows, raised.value.rejected, raised.value.error_rate) == (4, 2, 0.5)
