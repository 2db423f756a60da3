"""Load landed pages into the raw table, all or nothing."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.contract import EARLIEST, RAW
from drumlin.functions.clock import instant, text as clock_text, utc
from drumlin.operators.shape import shape, violations
from drumlin.operators.upsert import UPDATE, collapse, new_value
from drumlin.plans import key_index, lineage
from drumlin.session import discard, scratch, write_scratch
from drumlin.sources import pages as page_source
from drumlin.sources import tables

# Raw rows stay in the partition of their first load: an update never changes created_at.
PARTITION = "created_date"
KEY = "event_id"
# Note under which a version keeps the time of its load.
LOADED_AT = "loaded_at"


class LoadRejected(ValueError):
    """The batch breaks rules; nothing was written. ``rules`` maps rule to row count; ``rejected``
    of ``input_rows`` rows break one or more."""

    def __init__(self, rules: dict[str, int], input_rows: int, rejected: int):
        super().__init__(f"batch rejected, {rejected} of {input_rows} rows: {rules}")
        self.rules = rules
        self.input_rows = input_rows
        self.rejected = rejected

    @property
    def error_rate(self) -> float:
        return self.rejected / self.input_rows if self.input_rows else 0.0


class IncompletePull(ValueError):
    """A window has no page, or its pages have gaps, copies or no last page."""


@dataclass(frozen=True)
class LoadSummary:
    """What a load did. ``touched_dates`` are the event dates of old and new images up to the load's own
    time, ``first_later_date`` is the first one after it ("" if there is none)."""

    input_rows: int = 0
    distinct_keys: int = 0
    inserted: int = 0
    updated: int = 0
    touched_dates: tuple[str, ...] = ()
    first_later_date: str = ""


def read_raw(spark: SparkSession, root: str, parts=None) -> DataFrame:
    """The raw table's eight columns."""
    return tables.read(spark, root, RAW, parts, PARTITION).select(*RAW.names)


def check_complete(batch: DataFrame, window: tuple[datetime, datetime] | None = None) -> None:
    """Every window that landed is complete, and so is ``window``, the one that was pulled;
    without it, some window has to be there."""
    found = page_source.completeness(page_source.page_flags(batch))
    name = F.struct("window_start", "window_end")
    expected = page_source.is_window(*window) if window else F.lit(True)
    counts = found.agg(
        F.count_if(expected).alias("landed"),
        F.count_if(~F.col("complete")).alias("broken"),
        F.min(F.when(~F.col("complete"), name)).alias("first"),
    ).first()
    if not counts.landed:
        raise IncompletePull(f"no page landed for {window}" if window else "no page landed")
    if counts.broken:
        first = f"{counts.first.window_start}..{counts.first.window_end}"
        raise IncompletePull(f"{counts.broken} windows are incomplete, the first is {first}")


def load_pages(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    *,
    default_source: str,
    load_ts,
    update: Sequence[str] = UPDATE,
    require_complete: bool = True,
    window: tuple[datetime, datetime] | None = None,
    notes: dict[str, str] | None = None,
    lineage_root: str | None = None,
) -> LoadSummary:
    """Shape, check and upsert the pages of a pull (of ``window``, if given).

    The shaped batch is written once to shared scratch: the JSON is parsed a
    single time, and losing an executor later does not parse it again. With
    ``lineage_root`` the pages that delivered each key are kept there.
    """
    work = scratch(spark, "load")
    try:
        shaped = shape(page_source.events(pages), default_source)
        batch = write_scratch(shaped, f"{work}/batch")
        broken = {row.rule: row.rows for row in violations(batch).collect()}
        if broken:
            rows = batch.agg(F.count_if(page_source.is_event()), F.count_if(F.col("violations") != "")).first()
            raise LoadRejected(broken, *rows)
        if require_complete:
            check_complete(batch, window)
        if lineage_root:  # first, so that no row of the table lacks its pages
            lineage.record(batch.filter(page_source.is_event()), lineage_root, load_ts)
        return load_rows(
            batch.sparkSession,
            batch.filter(page_source.is_event()),
            root,
            order=page_source.ORDER,
            load_ts=load_ts,
            update=update,
            notes=notes,
        )
    finally:
        discard(spark, work)


def load_rows(
    spark: SparkSession,
    batch: DataFrame,
    root: str,
    *,
    order: Sequence[str],
    load_ts,
    update: Sequence[str] = UPDATE,
    notes: dict[str, str] | None = None,
) -> LoadSummary:
    """Upsert checked raw rows, rewriting only the partitions that hold a matched key.

    The key index names the partitions that may hold one of the batch's keys; of these
    alone the narrow columns are read, within the batch's key range. The staged changes then hold whole new rows, and the touched
    partitions are only filtered by key: their payloads never join anything.
    """
    before = tables.latest(spark, root)
    target = tables.read(spark, root, RAW, before.parts, PARTITION)
    columns = [c for c in RAW.names if c not in (KEY, "created_at")]

    if batch.isEmpty():
        return LoadSummary()
    changes = collapse(batch, KEY, columns, update, order)
    if before.parts:
        changes = changes.join(matched(spark, root, before, batch, update), KEY, "left")
    else:
        kept = T.StructType([RAW[name] for name in _kept_columns(update)])
        changes = changes.withColumns(
            {
                PARTITION: F.lit(None).cast("date"),
                "old_timestamp": F.lit(None).cast("timestamp"),
                "kept": F.lit(None).cast(kept),
            }
        )
    work = scratch(spark, "upsert")
    try:
        staged = write_scratch(changes, work)
        return _apply(spark, staged, target, before, root, load_ts, update, notes)
    finally:
        discard(spark, work)


def matched(
    spark: SparkSession, root: str, before: tables.Version, batch: DataFrame, update: Sequence[str] = UPDATE
) -> DataFrame:
    """The table's rows with a key of the batch: partition, old time and what an update keeps.

    Only partitions that the key index names are read, and of their files, which are sorted by key,
    the row groups within the batch's key range.
    """
    low, high = batch.agg(F.min(KEY), F.max(KEY)).first()
    dates = set(key_index.dates_of(spark, root, before, batch))
    near = tables.read(spark, root, RAW, [part for part in before.parts if part[0] in dates], PARTITION)
    known = near.filter(F.col(KEY).between(low, high)).select(
        KEY,
        PARTITION,
        F.col("timestamp").alias("old_timestamp"),
        F.struct(*_kept_columns(update)).alias("kept"),
    )
    return known.join(batch.select(KEY).distinct(), KEY, "left_semi")


def _kept_columns(update: Sequence[str]) -> list[str]:
    """What a matched row keeps of its old self."""
    kept = [c for c in RAW.names if c != KEY and c not in update]
    return kept if update else ["created_at"]


def _apply(
    spark: SparkSession,
    changes: DataFrame,
    target: DataFrame,
    before: tables.Version,
    root: str,
    load_ts,
    update: Sequence[str],
    notes: dict[str, str] | None,
) -> LoadSummary:
    """Write and publish the staged changes."""
    columns = [c for c in RAW.names if c not in (KEY, "created_at")]
    is_new = F.col(PARTITION).isNull()
    counts = changes.agg(
        F.sum("rows").alias("input_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(is_new).alias("inserted"),
    ).first()
    touched = tables.date_values(changes.filter(~is_new), PARTITION) if update else []

    load_time = instant(load_ts)

    def value(name: str) -> Column:
        if name in update or not update:  # without updates only new keys are written
            return new_value(name, update)
        return F.when(is_new, new_value(name, update)).otherwise(F.col(f"kept.{name}"))

    written = (changes if update else changes.filter(is_new)).select(
        KEY,
        *[value(name).alias(name) for name in columns],
        F.coalesce("kept.created_at", load_time).alias("created_at"),
        F.coalesce(PARTITION, F.to_date(load_time)).alias(PARTITION),
    )
    if touched:
        old = target.filter(F.col(PARTITION).isin(*[F.lit(d).cast("date") for d in touched]))
        changed = changes.filter(~is_new).select(KEY)
        written = old.join(changed, KEY, "left_anti").unionByName(written)
    new_parts = tables.write(written, root, PARTITION, KEY)

    dates, later = _touched_dates(changes, update, load_ts)
    added = changes.filter(is_new).select(KEY, F.to_date(load_time).alias(PARTITION))
    key_index.extend(spark, root, before, added)
    tables.publish(
        spark,
        root,
        tables.replace_parts(before.parts, new_parts, touched),
        {
            **before.notes,
            **(notes or {}),
            "touched": ",".join(dates),
            "touched_later": later,
            LOADED_AT: clock_text(load_ts),
        },
        base=before,
    )
    updated = counts.distinct_keys - counts.inserted if update else 0
    return LoadSummary(
        counts.input_rows, counts.distinct_keys, counts.inserted, updated, tuple(dates), later
    )


def _touched_dates(changes: DataFrame, update: Sequence[str], load_ts) -> tuple[list[str], str]:
    """Event dates of the old and new images up to the load time, and the first one after it.

    Those before the staging window do not matter. Later ones come from clocks that are wrong, and
    may be any number: the next build looks up those that it has to produce by itself.
    """
    is_new = F.col(PARTITION).isNull()
    changed = changes if update else changes.filter(is_new)
    new_time = new_value("timestamp", update)
    images = changed.select(F.explode(F.array("old_timestamp", new_time)).alias("event_time"))
    inside = images.filter(F.col("event_time") >= F.lit(EARLIEST).cast("timestamp"))
    days = inside.select(F.to_date("event_time").alias("day"))
    last = F.lit(utc(load_ts).date().isoformat()).cast("date")
    first_later = days.filter(F.col("day") > last).agg(F.min("day").cast("string")).first()[0]
    return tables.date_values(days.filter(F.col("day") <= last), "day"), first_later or ""
