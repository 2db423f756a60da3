import json
from pathlib import Path

from drumlin.plans.load import load_pages, read_raw
from drumlin.sources import tables
from drumlin.sources.pages import read_page_files
from drumlin.streaming.load import load_stream, page_file_stream, page_table_stream
from tests.helpers import LOAD_TS, SOURCE, event, pages, shown

FOLDER = "window_start=2024-02-01T00%3A00%3A00/window_end=2024-02-02T00%3A00%3A00"


def land(landing, page, batch):
    target = Path(landing) / FOLDER
    target.mkdir(parents=True, exist_ok=True)
    text = json.dumps({"data": batch, "pagination": {"has_more": False}})
    (target / f"page-{page:06d}.json").write_text(text)


def test_only_new_pages_are_loaded(spark, folder):
    landing, root, checkpoint = (f"{folder}/{name}" for name in ("landing", "raw", "checkpoint"))

    def go():
        stream = page_file_stream(spark, landing)
        load_stream(stream, root, checkpoint, default_source=SOURCE, load_ts=LOAD_TS)
        return tables.latest(spark, root).version

    land(landing, 1, [event("a", x=1), event("b")])
    land(landing, 2, [event("a", x=2)])
    assert go() == 1
    assert shown(read_raw(spark, root))["a"]["payload"] == '{"x":2}'
    assert go() == 1  # nothing new
    land(landing, 3, [event("c"), event("a", x=3)])
    assert go() == 2
    streamed = shown(read_raw(spark, root))
    assert streamed["a"]["payload"] == '{"x":3}'

    whole = f"{folder}/batch"
    everything = read_page_files(spark, landing)
    load_pages(spark, everything, whole, default_source=SOURCE, load_ts=LOAD_TS, require_complete=False)
    assert shown(read_raw(spark, whole)) == streamed


def test_replayed_batch_is_skipped(spark, folder):
    """The stream lost its record of the finished batch, not the table's."""
    landing, root, checkpoint = (f"{folder}/{name}" for name in ("landing", "raw", "checkpoint"))
    pages(spark, [event("a", x=1)]).write.parquet(landing)

    def go():
        stream = page_table_stream(spark, landing)
        load_stream(stream, root, checkpoint, default_source=SOURCE, load_ts=LOAD_TS)

    go()
    later = pages(spark, [event("a", x=2)])
    load_pages(spark, later, root, default_source=SOURCE, load_ts=LOAD_TS)
    for commit in Path(checkpoint, "commits").iterdir():
        commit.unlink()
    go()
    assert tables.latest(spark, root).version == 2
    assert shown(read_raw(spark, root))["a"]["payload"] == '{"x":2}'
