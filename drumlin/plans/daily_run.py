"""The daily job: load a pull window, build the marts, test them."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.functions.clock import utc
from drumlin.operators import quality
from drumlin.operators.profile import row_counts
from drumlin.plans import refresh
from drumlin.plans.load import LoadSummary, load_pages, load_rows, read_raw
from drumlin.plans.staging import stage
from drumlin.operators.upsert import IGNORE, UPDATE
from drumlin.session import configure
from drumlin.sources import tables
from drumlin.sources.seed import seed_rows

AFTER, BEFORE = "after", "before"


class QualityFailed(RuntimeError):
    """Column tests failed; ``failed`` lists (model, column, rule, failures)."""

    def __init__(self, failed: list[tuple]):
        super().__init__(f"column tests failed: {failed}")
        self.failed = failed


@dataclass(frozen=True)
class RunReport:
    load: LoadSummary
    results: DataFrame
    counts: DataFrame


def initialise(spark: SparkSession, layout: refresh.Layout, load_ts) -> LoadSummary:
    """Create the raw table if absent and insert the seed rows that are not there yet."""
    configure(spark)
    tables.create_if_absent(spark, layout.raw)
    rows = seed_rows(spark, load_ts).withColumn("seq", F.lit(0))
    return load_rows(spark, rows, layout.raw, order=["seq"], load_ts=load_ts, update=IGNORE)


def models(
    spark: SparkSession, layout: refresh.Layout, as_of, built: refresh.Build | None = None
) -> dict[str, DataFrame]:
    """The four tables by name, published or just built."""
    raw = read_raw(spark, layout.raw)
    return {
        quality.RAW: raw,
        quality.STAGING: stage(raw, as_of),
        quality.FACT: refresh.read_fact(spark, layout, built and built.fact),
        quality.DEVICES: refresh.read_devices(spark, layout, built and built.devices),
    }


def register_views(spark: SparkSession, layout: refresh.Layout, as_of=None) -> None:
    """Temporary views for SQL users, named as the tables."""
    for name, df in models(spark, layout, as_of).items():
        df.createOrReplaceTempView(name)


def stage_counts(load: LoadSummary, tables_by_name: dict[str, DataFrame]) -> DataFrame:
    """Rows at each stage of a run. A rejected batch never gets here."""
    counts = row_counts(tables_by_name).toDF("stage", "rows")
    steps = [
        ("read", load.input_rows),
        ("distinct_keys", load.distinct_keys),
        ("inserted", load.inserted),
        ("updated", load.updated),
    ]
    return counts.sparkSession.createDataFrame(steps, "stage string, rows bigint").union(counts)


def daily_run(
    spark: SparkSession,
    pages: DataFrame,
    layout: refresh.Layout,
    *,
    as_of: datetime | str | None,
    default_source: str,
    gate: str = AFTER,
    rules=quality.RULES,
    update=UPDATE,
    full: bool = False,
    require_complete: bool = True,
    window: tuple[datetime, datetime] | None = None,
) -> RunReport:
    """Safe to repeat for the same window. ``window`` is the one that was pulled: a pull of which
    nothing landed is then told from an empty one.

    ``gate='after'`` publishes the marts and then tests them; ``'before'``
    publishes only marts that pass.
    """
    if gate not in (AFTER, BEFORE):
        raise ValueError(f"gate is {AFTER!r} or {BEFORE!r}, not {gate!r}")
    configure(spark)
    as_of = utc(as_of)
    load = load_pages(
        spark,
        pages,
        layout.raw,
        default_source=default_source,
        load_ts=as_of,
        update=update,
        require_complete=require_complete,
        window=window,
    )
    built = refresh.build(spark, layout, as_of, full)
    if gate == AFTER:
        refresh.publish(spark, layout, built)
    frames = models(spark, layout, as_of, built)
    # One row per rule: a list the driver can hold, so the tests run once.
    rows = [tuple(row) for row in quality.evaluate(frames, rules).collect()]
    failed = [row[:4] for row in rows if not row[4]]
    if failed:
        raise QualityFailed(failed)
    if gate == BEFORE:
        refresh.publish(spark, layout, built)
    columns = "model string, `column` string, rule string, failures bigint, passed boolean"
    return RunReport(load, spark.createDataFrame(rows, columns), stage_counts(load, frames))
