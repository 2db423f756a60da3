"""The daily fact as a stream over the change feed, with late events as corrections.

The fact's counts are the sum of two layers, each a row per day, grain, combination of facet values
and time. The stream layer is what a stateful aggregation by day and grain holds: Spark keeps the
counts of days that are still open, drops a day's state once the watermark has passed its end, and
writes the totals that changed. A change of a day that is open when its load comes, but that the same
load closes, needs no state, as no later total of that day can follow: it is counted once and added to
the layer's rows, so that the state holds open days only, however many days a load brings. The
correction layer takes, by deltas, what the stream must not see: changes of days already closed, and
events that were in the future when they were loaded, once their time has come. Each change goes to
exactly one layer, by the feed alone: it is late if its day ended before the watermark of the loads
before its own, the latest event time of those loads that was not in their future, less the delay. A
micro-batch of the stream holds whole loads, so Spark's own watermark is never ahead of that.

Run after ``feed.record``; one writer at a time. A micro-batch that is replayed replaces its own totals.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.contract import EARLIEST, FACT, GRAIN, METRIC
from drumlin.functions import clock
from drumlin.operators import facets
from drumlin.operators.deltas import SUMS, settled, signed_combinations
from drumlin.plans import feed
from drumlin.plans.fact import fold
from drumlin.plans.fact_state import PARTITION, staged_signed
from drumlin.plans.refresh import Layout
from drumlin.session import configure, discard, scratch, write_scratch
from drumlin.sources import tables

KEYS = (*GRAIN, *facets.FACETS, "moment")
COMBINED = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in ("device_id", "event_type", *facets.FACETS)],
        T.StructField("moment", T.TimestampType()),
        *[T.StructField(name, METRIC if kind.startswith("decimal") else T.LongType()) for name, kind in SUMS.items()],
        T.StructField(PARTITION, T.DateType()),
    ]
)
#: Folders of a day's rows in a layer from which they are written as one.
MOST_PARTS = 16
FAR = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Marks:
    """The watermark before a load and after it."""

    before: str
    after: str


def stream_root(layout: Layout) -> str:
    return f"{layout.fact}_stream_combined"


def corrections_root(layout: Layout) -> str:
    return f"{layout.fact}_corrections_combined"


def fact_root(layout: Layout) -> str:
    return f"{layout.fact}_streamed"


def read_fact(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read(spark, fact_root(layout), FACT, None, PARTITION)


def _times(changes: DataFrame) -> DataFrame:
    """The times of both images of the changes."""
    return changes.select("load", "loaded_at", F.explode(F.array("old.timestamp", "new.timestamp")).alias("time"))


def marks_of(changes: DataFrame, delay: timedelta) -> dict[int, Marks]:
    """For each load the watermarks around it: one value a load reaches the driver."""
    inside = F.when(F.col("time") <= F.col("loaded_at"), F.col("time"))
    loads = _times(changes).groupBy("load").agg(F.max(inside).cast("string").alias("time")).orderBy("load").collect()
    found, high = {}, None
    mark = clock.text(EARLIEST)
    for row in loads:
        before = mark
        if row.time is not None:
            high = max(filter(None, (high, clock.utc(row.time))))
            mark = clock.text(high - delay)
        found[row.load] = Marks(before, mark)
    return found


def watermarks(changes: DataFrame, delay: timedelta) -> dict[int, str]:
    """For each load the watermark that holds when it comes."""
    return {load: mark.before for load, mark in marks_of(changes, delay).items()}


def _open(marks: dict[int, Marks], mark_of: Callable[[Marks], str]) -> Column:
    """Whether the day of a change is open at a mark of its load."""
    day_end = F.date_trunc("day", "time") + F.expr("interval 1 day")
    pairs = [x for load, mark in marks.items() for x in (F.lit(load).cast("long"), clock.instant(mark_of(mark)))]
    mark = F.element_at(F.create_map(*pairs), F.col("load")) if pairs else clock.instant(EARLIEST)
    return day_end > mark


def _on_time(marks: dict[int, Marks]) -> Column:
    """Whether a change belongs to the stream: not of its load's future, and its day is open."""
    return (F.col("time") <= F.col("loaded_at")) & _open(marks, lambda mark: mark.before)


def _stays(marks: dict[int, Marks]) -> Column:
    """Whether the day of a change is still open after its load."""
    return _open(marks, lambda mark: mark.after)


def _sides(changes: DataFrame) -> DataFrame:
    """A row for each image of a change: sign, time and the image."""
    both = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("old").alias("image")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("image"))
    )
    rows = changes.select("event_id", "loaded_at", "load", F.inline(both)).where("image is not null")
    return rows.withColumn("time", F.col("image.timestamp")).where(F.col("time") >= F.lit(EARLIEST).cast("timestamp"))


def _dated(sides: DataFrame) -> DataFrame:
    signed = sides.select("event_id", "image.*", "sign")
    return staged_signed(signed, FAR).withColumn(PARTITION, F.to_date("event_timestamp"))


def _add(spark: SparkSession, root: str, old: tables.Version, sides: DataFrame, notes: dict[str, str]) -> None:
    """Count changes into a layer; the rows it has stay where they are."""
    delta = signed_combinations(_dated(sides), GRAIN).select(*COMBINED.names)
    parts = [*old.parts, *tables.write(delta, root, PARTITION, "device_id")]
    count: dict[str, int] = {}
    for day, _ in parts:
        count[day] = count.get(day, 0) + 1
    many = {day for day, n in count.items() if n >= MOST_PARTS}
    if many:
        rows = tables.read(spark, root, COMBINED, [part for part in parts if part[0] in many], PARTITION)
        parts = tables.replace_parts(parts, tables.write(rows, root, PARTITION, "device_id"), many)
    tables.publish(spark, root, parts, {**old.notes, **notes}, base=old)


def advance(spark: SparkSession, layout: Layout, checkpoint: str, as_of, delay: timedelta = timedelta(days=1)) -> int:
    """Take in the loads recorded since the last call; returns how many changes became corrections."""
    configure(spark)
    as_of = clock.utc(as_of)
    marks = marks_of(feed.read(spark, layout.raw), delay)
    _stream(spark, layout, checkpoint, marks, delay)
    _close(spark, layout, marks)
    late = _correct(spark, layout, marks, as_of)
    _fold(spark, layout, as_of)
    return late


def _stream(spark: SparkSession, layout: Layout, checkpoint: str, marks: dict[int, Marks], delay: timedelta) -> None:
    arriving = spark.readStream.schema(feed.FEED).parquet(feed.root_of(layout.raw))
    sides = _sides(arriving).where(_on_time(marks) & _stays(marks))
    dated = _dated(sides).withWatermark("event_timestamp", f"{int(delay.total_seconds())} seconds")
    counts = _stateful(dated)
    root = stream_root(layout)

    def put(totals: DataFrame, number: int) -> None:
        old = tables.latest(spark, root)
        if number <= int(old.notes.get("batch", -1)):
            return
        work = scratch(spark, "totals")
        try:
            # Once: each reading of the totals would run the batch's aggregation and save its state again.
            totals = write_scratch(totals.select(*COMBINED.names), work)
            days = tables.date_values(totals, PARTITION)
            before = tables.read(spark, root, COMBINED, [part for part in old.parts if part[0] in set(days)], PARTITION)
            same = [F.col(f"b.{c}").eqNullSafe(F.col(f"t.{c}")) for c in KEYS]
            kept = before.alias("b").join(totals.alias("t"), same, "left_anti")
            written = tables.write(kept.unionByName(totals), root, PARTITION, "device_id") if days else []
            parts = tables.replace_parts(old.parts, written, days)
            tables.publish(spark, root, parts, {**old.notes, "batch": str(number)}, base=old)
        finally:
            discard(spark, work)

    query = (
        counts.writeStream.outputMode("update").foreachBatch(put)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _stateful(dated: DataFrame) -> DataFrame:
    """Totals by day: the window lets Spark drop the state of a day that the watermark has passed."""
    by_day = dated.withColumn("day", F.window("event_timestamp", "1 day"))
    return signed_combinations(by_day, (*GRAIN, "day")).drop("day")


def _close(spark: SparkSession, layout: Layout, marks: dict[int, Marks]) -> None:
    """Add the changes of days that their own load closed, since the last run. The stream has written all
    it will ever write of these days."""
    root = stream_root(layout)
    old = tables.latest(spark, root)
    done = int(old.notes.get("closed", 0))
    load = max(marks, default=done)
    if load <= done:
        return
    sides = _sides(feed.read(spark, layout.raw, after=done)).where(_on_time(marks) & ~_stays(marks))
    _add(spark, root, old, sides, {"closed": str(load)})


def _correct(spark: SparkSession, layout: Layout, marks: dict[int, Marks], as_of) -> int:
    """Apply the changes that the stream left out and whose time has come since the last run."""
    root = corrections_root(layout)
    old = tables.latest(spark, root)
    done, before = int(old.notes.get("load", 0)), old.notes.get("as_of")
    due = ~_on_time(marks) & (F.col("time") >= F.lit(EARLIEST).cast("timestamp")) & (F.col("time") <= clock.instant(as_of))
    if before is not None:
        due &= (F.col("load") > done) | (F.col("time") > clock.instant(before))
    changes = feed.read(spark, layout.raw)
    late = _times(changes).where(due).count()
    notes = {"load": str(max(marks, default=done)), "as_of": clock.text(as_of)}
    if late:
        _add(spark, root, old, _sides(changes).where(due), notes)
    else:
        tables.publish(spark, root, old.parts, {**old.notes, **notes}, base=old)
    return late


def _fold(spark: SparkSession, layout: Layout, as_of) -> None:
    """Fold the days of which a layer has changed."""
    layers = [tables.latest(spark, root(layout)) for root in (stream_root, corrections_root)]
    root = fact_root(layout)
    old = tables.latest(spark, root)
    now: dict[str, str] = {}
    for layer in layers:
        for day, folder in layer.parts:
            now[day] = f"{now.get(day, '')}{folder.split('/')[0].removeprefix('run=')};"
    known = dict(item.split("=", 1) for item in old.notes.get("folded", "").split(",") if item)
    stale = sorted(day for day in {*known, *now} if known.get(day) != now.get(day))
    parts = list(old.parts)
    if stale:
        stream, corrections = (
            tables.read(spark, root_of(layout), COMBINED, [part for part in layer.parts if part[0] in set(stale)], PARTITION)
            for root_of, layer in zip((stream_root, corrections_root), layers, strict=True)
        )
        counts = settled(facets.dealt(stream.unionByName(corrections), GRAIN), GRAIN)
        parts = tables.replace_parts(parts, tables.write(fold(counts, as_of), root, PARTITION, "device_id"), stale)
    notes = {"folded": ",".join(f"{day}={x}" for day, x in sorted(now.items()))}
    tables.publish(spark, root, parts, {**old.notes, **notes}, base=old)
