"""Device history: which attributes a device had, from when to when (type 2).

A range lasts from the event that brought its attributes to the next event that brought others. Two
levels keep a busy device from being one task: within a device and hour, events become runs of equal
attributes; the runs of a device are then joined where an hour goes on as the one before. Runs are
kept by day, so an event that comes late changes the runs of its own day, and the ranges around it are
spliced by folding the device's runs, not its events.

Of events at one instant the one with the largest id counts, as in the dimension. Ranges have no gaps
and no overlaps: each ends where the next begins, and the last is open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from drumlin.contract import EARLIEST
from drumlin.functions import clock
from drumlin.plans import feed
from drumlin.plans.dimension import ATTRIBUTES
from drumlin.plans.load import read_raw
from drumlin.plans.refresh import Layout, on_dates
from drumlin.plans.staging import stage
from drumlin.sources import tables

PARTITION = "metric_date"
_TEXTS = [T.StructField(name, T.StringType()) for name in ATTRIBUTES]
RUNS = T.StructType(
    [T.StructField("device_id", T.StringType()), T.StructField("seen_at", T.TimestampType()), *_TEXTS, T.StructField(PARTITION, T.DateType())]
)
HISTORY = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("version", T.IntegerType()),
        *_TEXTS,
        T.StructField("valid_from", T.TimestampType()),
        T.StructField("valid_to", T.TimestampType()),
        T.StructField("is_current", T.BooleanType()),
    ]
)


def _first_of_runs(rows: DataFrame, *group: str) -> DataFrame:
    """Rows that differ from the one before in their group, or have none before."""
    order = Window.partitionBy(*group).orderBy("seen_at")
    own = F.struct(*ATTRIBUTES)
    placed = rows.withColumn("before", F.lag(own).over(order)).withColumn("first", F.row_number().over(order) == 1)
    return placed.where(F.col("first") | ~own.eqNullSafe(F.col("before"))).drop("before", "first")


def runs(staging: DataFrame) -> DataFrame:
    """The first event of each run of equal attributes within a device and hour."""
    instants = staging.groupBy("device_id", F.col("event_timestamp").alias("seen_at")).agg(
        F.max_by(F.struct(*ATTRIBUTES), "event_id").alias("own")
    )
    rows = instants.select("device_id", "seen_at", "own.*").withColumn("hour", F.date_trunc("hour", "seen_at"))
    return _first_of_runs(rows, "device_id", "hour").drop("hour").withColumn(PARTITION, F.to_date("seen_at")).select(*RUNS.names)


def from_runs(found: DataFrame) -> DataFrame:
    """The history: runs that differ from the one before, each valid until the next."""
    order = Window.partitionBy("device_id").orderBy("seen_at")
    changes = _first_of_runs(found, "device_id").withColumn("valid_to", F.lead("seen_at").over(order))
    return changes.select(
        "device_id",
        F.row_number().over(order).cast("int").alias("version"),
        *ATTRIBUTES,
        F.col("seen_at").alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def dim_history(staging: DataFrame) -> DataFrame:
    return from_runs(runs(staging))


def runs_root(layout: Layout) -> str:
    return f"{layout.devices}_runs"


def history_root(layout: Layout) -> str:
    return f"{layout.devices}_history"


def read_history(spark: SparkSession, layout: Layout) -> DataFrame:
    return tables.read(spark, history_root(layout), HISTORY)


def refresh(spark: SparkSession, layout: Layout, as_of) -> list[str]:
    """Make the runs of the days anew that the change feed touched or whose time has come, and splice
    the history; returns those days."""
    as_of = clock.utc(as_of)
    old = tables.latest(spark, runs_root(layout))
    changes = feed.read(spark, layout.raw, after=int(old.notes.get("load", 0)))
    load = feed.recorded(spark, layout.raw)
    times = changes.select(F.explode(F.array("old.timestamp", "new.timestamp")).alias("time"))
    raw = read_raw(spark, layout.raw)
    if "as_of" in old.notes:
        low, high = sorted([clock.utc(old.notes["as_of"]), as_of])
        time = F.col("timestamp")
        times = times.union(raw.where((time > clock.instant(low)) & (time <= clock.instant(high))).select("timestamp"))
    due = times.where((F.col("time") <= clock.instant(as_of)) & (F.col("time") >= clock.instant(EARLIEST)))
    days = tables.date_values(due.select(F.to_date("time").alias("day")), "day")
    parts = list(old.parts)
    if days:
        made = runs(stage(on_dates(raw, "timestamp", days), as_of))
        parts = tables.replace_parts(parts, tables.write(made, runs_root(layout), PARTITION, "device_id"), days)
    history = from_runs(tables.read(spark, runs_root(layout), RUNS, parts, PARTITION))
    tables.publish(spark, history_root(layout), tables.write(history, history_root(layout)))
    tables.publish(spark, runs_root(layout), parts, {"load": str(load), "as_of": clock.text(as_of)}, base=old)
    return days
