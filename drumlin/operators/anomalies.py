"""Days whose metrics stand far from the days before them, and how the worst of them rank.

Each device and event type is a series with one row a day. A day is compared with the median of the days
before it, in units of their median absolute deviation, so single wild days do not hide the next one.
All of it is exact: medians are kept doubled and deviations fourfold, as integers.

Ranks by ``row_number() over (partition by event_type)`` would sort a type with a third of all rows in one
task. Here scores are whole thousandths, so equal ones are counted together before any shuffle, and the
counts are added up on two levels: buckets of scores, then the scores of a bucket. Both have a fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drumlin.session import scratch, write_scratch

METRICS = ("event_count", "unique_sessions", "unique_users", "total_duration_ms")
SERIES = ("device_id", "event_type")
#: Days looked back on, and how many of them must have the metric.
DAYS, LEAST_DAYS = 28, 7
#: |score| from which a day is an anomaly (Iglewicz and Hoaglin).
THRESHOLD = 3.5
#: The deviation counts as at least this share of the median, and as at least half a unit.
LEAST_SHARE = 0.05
#: Scores saturate here, in thousandths; a bucket holds this many scores.
LARGEST, BUCKET = 10**9, 1 << 15


def _twice_median(ordered: Column) -> Column:
    """Sum of the two middle values of a sorted array; null of an empty one."""
    size = F.size(ordered)
    low, high = F.floor((size + 1) / 2).cast("int"), F.floor(size / 2).cast("int") + 1
    return F.when(size > 0, F.element_at(ordered, low) + F.element_at(ordered, high))


def scores(
    fact: DataFrame,
    metrics: Sequence[str] = METRICS,
    days: int = DAYS,
    least_days: int = LEAST_DAYS,
    first_day: str | None = None,
) -> DataFrame:
    """One row per row of the fact and metric: value, number of days compared with, their median and median
    absolute deviation, and ``score`` = 0.6745 * (value - median) / deviation, cut to thousandths.

    Metrics are whole numbers. Only days from ``days`` before to the day before count, and of these only
    those on which the series has a row with the metric; a day without events is no observation. Days with
    fewer than ``least_days`` of them, or without the metric, are left out. ``first_day`` restricts the
    result, and the fact is then read from ``days`` before it. A series holds one row a day and the frame at most
    ``days`` of them, so no group grows with the events; repeated rows of a day are refused by the fact's key."""
    day = F.unix_date("metric_date")
    if first_day is not None:
        start = F.lit(first_day).cast("date")
        fact = fact.where(F.col("metric_date") >= F.date_sub(start, days))
    before = Window.partitionBy(*SERIES).orderBy(day).rangeBetween(-days, -1)
    seen = fact.select(
        *SERIES,
        "metric_date",
        *[F.col(m).cast("bigint").alias(m) for m in metrics],
        *[F.collect_list(F.col(m).cast("bigint")).over(before).alias(f"{m} before") for m in metrics],
    )
    if first_day is not None:
        seen = seen.where(F.col("metric_date") >= F.lit(first_day).cast("date"))
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"), F.col(f"{m} before").alias("before")) for m in metrics]
    )
    rows = seen.select(*SERIES, "metric_date", F.inline(entries)).where(
        F.col("value").isNotNull() & (F.size("before") >= least_days)
    )
    # Neither list holds a null. Each is sorted once, in a column of its own.
    rows = rows.withColumn("before", F.sort_array("before")).withColumn("median2", _twice_median(F.col("before")))
    off = F.transform("before", lambda x: F.abs(x * 2 - F.col("median2")))
    rows = rows.withColumn("off", F.sort_array(off)).withColumn("mad4", _twice_median(F.col("off")))
    # Half of a share of the doubled median, in quarters; half a unit is two of them.
    least = F.floor(F.abs("median2") * (2 * LEAST_SHARE)).cast("bigint")
    distance = (F.col("value") * 2 - F.col("median2")).cast("double")
    size = F.abs(distance) * 1349.0 / F.greatest("mad4", least, F.lit(2).cast("bigint")).cast("double")
    size = F.floor(F.least(size, F.lit(float(LARGEST)))).cast("bigint")
    result = F.struct(
        F.size("before").cast("bigint").alias("days"),
        (F.col("median2") / F.lit(2.0)).alias("median"),
        (F.col("mad4") / F.lit(4.0)).alias("mad"),
        (F.when(distance < 0, -size).otherwise(size) / F.lit(1000.0)).alias("score"),
    )
    # A filter on the score stays above a generator; pushed down it would compute every score twice.
    return rows.select(*SERIES, "metric_date", "metric", "value", F.inline(F.array(result)))


def ranked(rows: DataFrame, by: Sequence[str], score: str = "score") -> DataFrame:
    """The rows with ``rank``: 1 plus the number of rows of the same ``by`` with a larger |score|; equal ones
    share it. ``score`` counts in thousandths, up to ``LARGEST``.

    The counts are at most BUCKET scores a bucket and LARGEST / BUCKET buckets a group (30,518), whatever the
    number of rows. Rows then meet their score's rank; a score that very many rows share is one key of that
    join, whose rows AQE splits, as the other side has one row."""
    height = F.round(F.abs(score) * 1000).cast("bigint")
    marked = rows.withColumns({"height": height, "bucket": F.floor(height / BUCKET).cast("bigint")})
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by]
    marked = marked.withColumn("group", F.struct(*keys, *[F.col(c).isNull() for c in by]))
    counted = marked.groupBy("group", "bucket", "height").agg(F.count("*").alias("n"))
    above = lambda *of: Window.partitionBy(*of).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    buckets = counted.groupBy("group", "bucket").agg(F.sum("n").alias("n"))
    offset = F.coalesce(F.sum("n").over(above("group").orderBy(F.desc("bucket"))), zero)
    buckets = buckets.select("group", "bucket", offset.alias("offset"))
    inside = F.coalesce(F.sum("n").over(above("group", "bucket").orderBy(F.desc("height"))), zero)
    placed = counted.withColumn("inside", inside).join(buckets, ["group", "bucket"])
    placed = placed.select("group", "height", (F.col("offset") + F.col("inside") + 1).alias("rank"))
    return marked.join(placed, ["group", "height"]).select(*rows.columns, "rank")


def anomalies(fact: DataFrame, threshold: float = THRESHOLD, **options) -> DataFrame:
    """Scores of ``threshold`` or more either way, with their rank within event type and metric. Options are
    those of ``scores``. An empty fact has none.

    What stands out is written once to shared scratch: ranks read it three times."""
    found = scores(fact, **options).where(F.abs("score") >= threshold)
    kept = write_scratch(found, scratch(fact.sparkSession, "anomalies"))
    return ranked(kept, ("event_type", "metric"))
