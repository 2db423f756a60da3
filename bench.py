"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every job runs over the whole ``events`` table as telemetry. The best of a few
runs is reported, as the first one compiles code.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession

from drumlin.operators import quality
from drumlin.plans import daily_run, dimension, fact, fact_state, feed, load, refresh
from drumlin.plans.staging import stage
from drumlin.session import configure, scratch
from drumlin.sources.pages import read_page_table
from drumlin.streaming.load import load_stream, page_table_stream
from registry import fixture
from registry.fixture import AS_OF, LOADED, RELOADED, SOURCE

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def best(job: Callable[[], object], runs: int) -> float:
    times = []
    for _ in range(runs):
        start = time.perf_counter()
        result = job()
        if isinstance(result, DataFrame):
            result.write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = session()
    landing = scratch(spark, "landing")
    # A pull lands as many files; the test table is a single one.
    fixture.pages(spark, SF_DIR).repartition(int(CPUS)).write.parquet(landing)
    pages = read_page_table(spark, landing)

    def new_layout() -> refresh.Layout:
        return refresh.Layout(scratch(spark, "tables"))

    def load_batch() -> refresh.Layout:
        layout = new_layout()
        load.load_pages(
            spark, pages, layout.raw, default_source=SOURCE, load_ts=LOADED, require_complete=False
        )
        return layout

    def stream() -> None:
        layout = new_layout()
        load_stream(
            page_table_stream(spark, landing),
            layout.raw,
            f"{layout.root}/checkpoint",
            default_source=SOURCE,
            load_ts=LOADED,
        )

    layout = load_batch()
    raw = load.read_raw(spark, layout.raw)
    staging = stage(raw, AS_OF)

    def build_full() -> None:
        refresh.publish(spark, layout, refresh.build(spark, layout, AS_OF, full=True))

    def upsert_again() -> None:
        late = fixture.late_batch(spark, SF_DIR)
        load.load_rows(spark, late, layout.raw, order=["n"], load_ts=RELOADED)

    def build_touched() -> None:
        """Once only: what it publishes is no longer touched."""
        refresh.publish(spark, layout, refresh.build(spark, layout, AS_OF))

    one_day = new_layout()

    def touch_one_day() -> None:
        """A copy of the marts, then a late event on a single day."""
        load.load_rows(spark, fixture.raw_table(spark, SF_DIR), one_day.raw, order=["event_id"], load_ts=LOADED)
        refresh.publish(spark, one_day, refresh.build(spark, one_day, AS_OF, full=True))
        feed.record(spark, one_day.raw)
        fact_state.apply(spark, one_day, AS_OF)
        late = fixture.late_batch(spark, SF_DIR).where("n % 97 = 7 and to_date(timestamp) = date'2024-01-12'")
        load.load_rows(spark, late, one_day.raw, order=["n"], load_ts=RELOADED)

    def build_one_day() -> None:
        refresh.build(spark, one_day, AS_OF)

    def delta_one_day() -> None:
        """The same day by the change feed and corrected counts; once only."""
        feed.record(spark, one_day.raw)
        fact_state.apply(spark, one_day, AS_OF)

    def suite() -> DataFrame:
        return quality.evaluate(daily_run.models(spark, layout, AS_OF))

    jobs: dict[str, tuple[Callable[[], object], int]] = {
        "load_batch": (load_batch, 3),
        "stream_load": (stream, 2),
        "stage_clean": (lambda: staging.drop("raw_payload"), 4),
        "fact_daily": (lambda: fact.fact_daily(staging, AS_OF), 4),
        "dim_devices": (lambda: dimension.dim_devices(staging, AS_OF), 4),
        "build_full": (build_full, 3),
        "dq_suite": (suite, 3),
        "upsert_again": (upsert_again, 2),
        "build_touched": (build_touched, 1),
        "build_one_day": (build_one_day, 3),
        "delta_one_day": (delta_one_day, 1),
    }
    touch_one_day()
    times = {name: best(job, runs) for name, (job, runs) in jobs.items()}
    print(
        json.dumps(
            {
                "metric": "total_best_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "runs": "warm JVM; best of " + ", ".join(f"{n} ({name})" for name, (_, n) in jobs.items()),
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
