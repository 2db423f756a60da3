from datetime import datetime
from pathlib import Path

import pytest

from drumlin.operators.shape import shape, violations
from drumlin.sources import pages as P
from tests.helpers import SOURCE, WINDOW, event, pages


def documents(spark, *texts, window=WINDOW):
    rows = [(*window, number, text) for number, text in enumerate(texts, start=1)]
    return spark.createDataFrame(rows, P.PAGES)


@pytest.mark.parametrize(
    "text, ok, has_more, size",
    [
        ('{"data": [{"a": 1}, {"a": 2}], "pagination": {"has_more": true}}', True, True, 2),
        ('{"pagination": {"has_more": false}}', True, False, -1),
        ('{"data": []}', True, False, 0),
        ('{"data": [], "pagination": {}}', True, False, 0),
        ('{"data": {"a": 1}}', False, False, -1),
        ('{"data": null}', False, False, -1),
        ('{"data": [], "pagination": null}', False, False, 0),
        ('[{"data": []}]', False, False, -1),
        ('{"data": [', False, False, -1),
    ],
)
def test_envelope(spark, text, ok, has_more, size):
    row = P.decode(documents(spark, text)).selectExpr("page_ok", "has_more", "size(data) n").first()
    assert (row.page_ok, row.has_more) == (ok, has_more)
    assert (row.n if row.n is not None else -1) == size


def test_events_keep_delivery_order(spark):
    rows = P.events(pages(spark, [event("a"), event("b")], [event("c")]))
    got = rows.selectExpr("page", "pos", "variant_get(event, '$.event_id', 'string') id")
    assert sorted(map(tuple, got.collect())) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]


def test_empty_page_counts_as_delivered(spark):
    rows = P.events(pages(spark, [event("a")], []))
    assert P.completeness(P.page_flags(rows)).first().complete
    assert rows.filter(P.is_event()).count() == 1


def complete(spark, flags):
    rows = [(*WINDOW, page, more) for page, more in flags]
    schema = "window_start string, window_end string, page bigint, has_more boolean"
    return P.completeness(spark.createDataFrame(rows, schema)).first().complete


def test_completeness(spark):
    assert complete(spark, [(1, True), (2, True), (3, False)])
    assert not complete(spark, [(1, True), (2, True), (4, False)])  # gap
    assert not complete(spark, [(1, True), (2, True)])  # no last page
    assert not complete(spark, [(1, False), (2, False)])  # two last pages
    assert not complete(spark, [(1, False), (2, True)])  # last page in the middle
    assert not complete(spark, [(1, True), (2, False), (2, False)])  # a page twice
    assert not complete(spark, [(2, True), (3, False)])  # first page missing


def test_page_files_and_windows(spark, folder):
    for day, count in ((1, 2), (2, 1)):
        window = f"window_start=2024-02-0{day}T00%3A00%3A00/window_end=2024-02-0{day + 1}T00%3A00%3A00"
        target = Path(folder) / window
        target.mkdir(parents=True)
        for page in range(1, count + 1):
            text = '{\n "data": [{"event_id": "%d-%d"}]\n}' % (day, page)
            (target / f"page-{page:06d}.json").write_text(text)
    found = P.read_page_files(spark, folder)
    assert sorted(r.page for r in found.collect()) == [1, 1, 2]
    one = P.in_window(found, datetime(2024, 2, 1), datetime(2024, 2, 2))
    assert sorted(r.page for r in one.collect()) == [1, 2]
    assert "PartitionFilters: [isnotnull(window_start" in one._jdf.queryExecution().toString()
    ids = P.events(one).selectExpr("variant_get(event, '$.event_id', 'string') id").collect()
    assert sorted(r.id for r in ids) == ["1-1", "1-2"]


def test_bad_page_is_one_violation(spark):
    rows = shape(P.events(documents(spark, '{"data": [', '{"data": ["text", 3]}')), SOURCE)
    found = {r.rule: r["rows"] for r in violations(rows).collect()}
    assert found == {"malformed_page": 1, "event_not_object": 2}
