"""What a job does by the size of its data: how rows are dealt, how files can be shared out."""

import pyarrow.parquet as parquet
from pathlib import Path

from drumlin import session
from drumlin.operators import facets
from drumlin.plans.fact import fact_daily, fact_of_job
from drumlin.sources import tables
from drumlin.plans.staging import stage
from tests.helpers import AS_OF, raw


def staged(spark):
    """One hot group, many small ones, payloads with and without the keys of the fact."""
    rows = []
    for i in range(400):
        device = "hot" if i % 2 else f"d{i % 60}"
        payload = f'{{"session_id": "s{i % 7}", "country": "c{i % 3}", "duration_ms": {i}}}' if i % 5 else "{}"
        rows.append((f"e{i}", device, "t", f"2024-02-0{1 + i % 4} 00:00:{i % 60:02d}", payload))
    return stage(raw(spark, rows), AS_OF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_groups_are_dealt_once(spark, monkeypatch):
    rows = staged(spark)
    lazy = sorted(fact_daily(rows, AS_OF).collect())
    job = fact_of_job(rows, AS_OF)
    assert plan(job).count("Exchange hashpartitioning") == 1
    assert sorted(job.collect()) == lazy
    # A hot group is spread as before.
    dated = rows.selectExpr("*", "to_date(event_timestamp) as metric_date")
    assert facets.dealt(dated, ["device_id", "metric_date"], 99) is dated
    monkeypatch.setattr(facets.dealt, "__defaults__", (99,))
    spread = fact_of_job(rows, AS_OF)
    assert plan(spread).count("Exchange hashpartitioning") == 3
    assert sorted(spread.collect()) == lazy


def test_no_rows(spark):
    assert fact_of_job(staged(spark).where("false"), AS_OF).count() == 0


def row_groups(folder):
    return [parquet.ParquetFile(f).metadata.num_row_groups for f in Path(folder).rglob("*.parquet")]


def test_files_can_be_shared_out(spark, folder, monkeypatch):
    """A file of one row group is one task, whatever the number of cores."""
    rows = spark.range(0, 400_000, 1, 1).selectExpr("id", "sha2(string(id), 256) as text", "date'2024-02-01' as day")
    session.write_scratch(rows, f"{folder}/scratch")
    tables.write(rows, f"{folder}/whole")
    tables.write(rows, f"{folder}/by_day", "day", "id")
    for place in ("scratch", "whole/data", "by_day/data"):
        assert max(row_groups(f"{folder}/{place}")) > 1
    assert spark.read.parquet(f"{folder}/scratch").count() == 400_000
