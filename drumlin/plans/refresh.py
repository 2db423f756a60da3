"""Build or refresh the marts from the raw table.

A refresh recomputes the days that changed: the old and new dates of every
loaded event, and the dates of events that were in the future at the last
build and have come to pass. The rest of the fact is not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.contract import DEVICE_DAYS, DIMENSION, EARLIEST, FACT
from drumlin.functions import clock
from drumlin.plans.dimension import device_days, from_device_days
from drumlin.plans.fact import fact_of_job
from drumlin.plans.load import read_raw
from drumlin.plans.staging import stage
from drumlin.sources import tables

PARTITION = "metric_date"


@dataclass(frozen=True)
class Layout:
    """Where the tables live below a shared root."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/telemetry_events"

    @property
    def fact(self) -> str:
        return f"{self.root}/analytics/fct_telemetry_metrics"

    @property
    def device_days(self) -> str:
        return f"{self.root}/analytics/device_days"

    @property
    def devices(self) -> str:
        return f"{self.root}/analytics/dim_devices"


@dataclass(frozen=True)
class Build:
    """Written, unpublished marts."""

    fact: list[tuple[str, str]]
    device_days: list[tuple[str, str]]
    devices: list[tuple[str, str]]
    notes: dict[str, str]


def read_fact(spark: SparkSession, layout: Layout, parts=None) -> DataFrame:
    return tables.read(spark, layout.fact, FACT, parts, PARTITION)


def read_device_days(spark: SparkSession, layout: Layout, parts=None) -> DataFrame:
    return tables.read(spark, layout.device_days, DEVICE_DAYS, parts, PARTITION)


def read_devices(spark: SparkSession, layout: Layout, parts=None) -> DataFrame:
    return tables.read(spark, layout.devices, DIMENSION, parts)


def runs_of_days(dates) -> list[tuple[date, date]]:
    """First day of each run of consecutive days, and the day after its last."""
    runs: list[tuple[date, date]] = []
    for day in sorted({date.fromisoformat(d) for d in dates}):
        after = day + timedelta(days=1)
        if runs and runs[-1][1] == day:
            runs[-1] = (runs[-1][0], after)
        else:
            runs.append((day, after))
    return runs


def on_dates(rows: DataFrame, column: str, dates) -> DataFrame:
    """Rows on the given days. One range per run of days reaches the scan as a pushed filter, so
    two distant days do not read what lies between."""
    parts: list[Column] = [
        (F.col(column) >= clock.instant(f"{start}T00:00:00")) & (F.col(column) < clock.instant(f"{end}T00:00:00"))
        for start, end in runs_of_days(dates)
    ]
    if not parts:
        return rows.limit(0)
    while len(parts) > 1:  # pairwise, so that many runs make no deep expression
        parts = [reduce(lambda a, b: a | b, parts[i : i + 2]) for i in range(0, len(parts), 2)]
    return rows.filter(parts[0])


def pending_dates(spark: SparkSession, layout: Layout, raw: DataFrame, as_of) -> list[str]:
    """Days to recompute since the fact was last published."""
    notes = tables.latest(spark, layout.fact).notes
    loads = tables.versions_since(spark, layout.raw, int(notes["raw_version"]))
    touched = {day for load in loads for day in load.notes.get("touched", "").split(",") if day}
    # The clock moved: events between the two run times came in, or fell out if it moved back.
    before, after = sorted([clock.utc(notes["as_of"]), clock.utc(as_of)])
    time = F.col("timestamp")
    earliest = F.lit(EARLIEST).cast("timestamp")
    due = (time > clock.instant(before)) & (time <= clock.instant(after))
    # A load touched days after its own time: of those, the ones a build can have produced.
    later = {load.notes.get("touched_later", "") for load in loads} - {""}
    plain = [date.fromisoformat(day) for day in later if not day.startswith("+")]
    first = min(plain, default=None)
    if first is not None and first <= after.date():
        due |= (time >= clock.instant(f"{first}T00:00:00")) & (time <= clock.instant(after))
        touched |= {day for day, _ in tables.latest(spark, layout.fact).parts if date.fromisoformat(day) >= first}
    days = raw.filter(due & (time >= earliest)).select(F.to_date(time).alias("day"))
    return sorted(touched | set(tables.date_values(days, "day")))


def build(spark: SparkSession, layout: Layout, as_of, full: bool = False) -> Build:
    """Write new mart parts; ``publish`` makes them visible."""
    as_of = clock.utc(as_of)
    raw_version = tables.latest(spark, layout.raw)
    raw = read_raw(spark, layout.raw, raw_version.parts)
    notes = {"raw_version": str(raw_version.version), "as_of": clock.text(as_of)}
    old_fact = tables.latest(spark, layout.fact)
    old_days = tables.latest(spark, layout.device_days)
    if full or "raw_version" not in old_fact.notes:
        staging, replaced = stage(raw, as_of), None
    else:
        replaced = pending_dates(spark, layout, raw, as_of)
        staging = stage(on_dates(raw, "timestamp", replaced), as_of)

    fact_parts = tables.write(fact_of_job(staging, as_of), layout.fact, PARTITION, "device_id")
    day_parts = tables.write(device_days(staging), layout.device_days, PARTITION, "device_id")
    if replaced is not None:
        fact_parts = tables.replace_parts(old_fact.parts, fact_parts, replaced)
        day_parts = tables.replace_parts(old_days.parts, day_parts, replaced)
    devices = from_device_days(read_device_days(spark, layout, day_parts), as_of)
    return Build(fact_parts, day_parts, tables.write(devices, layout.devices), notes)


def publish(spark: SparkSession, layout: Layout, built: Build) -> None:
    """The fact goes last: its notes tell the next refresh where to resume, so a run that
    stops in between is simply repeated."""
    tables.publish(spark, layout.device_days, built.device_days)
    tables.publish(spark, layout.devices, built.devices)
    tables.publish(spark, layout.fact, built.fact, built.notes)
