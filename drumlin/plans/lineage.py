"""Which pages a row came from: first and last delivery of each key, and the pages behind a row of the fact.

A load appends one narrow row per key to a table beside the raw one. Such rows merge by minimum, maximum and sum,
so the lineage of a key is folded from its loads whatever their order, and no list of deliveries is kept
with any row. A load that is run again under its own time replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.contract import GRAIN
from drumlin.functions.clock import instant, utc
from drumlin.sources.pages import ORDER

PLACE = "struct<loaded_at: timestamp, window_start: string, window_end: string, page: bigint, pos: int>"
TABLE = f"event_id string, deliveries bigint, first {PLACE}, last {PLACE}, load string"
#: Hexadecimal digits of a page's hash in the digest of a set of pages.
_DIGITS = 8


def _folded(rows: DataFrame) -> DataFrame:
    """Combined before its shuffle with buffers of fixed width: a key that every page delivers is one row a task."""
    return rows.groupBy("event_id").agg(
        F.sum("deliveries").alias("deliveries"), F.min("first").alias("first"), F.max("last").alias("last")
    )


def record(batch: DataFrame, root: str, load_ts) -> None:
    """Keep the deliveries of a shaped batch (with ``ORDER``) as those of the load at ``load_ts``."""
    place = F.struct(instant(load_ts).alias("loaded_at"), *ORDER).cast(PLACE)
    rows = batch.select("event_id", F.lit(1).cast("bigint").alias("deliveries"), place.alias("first"), place.alias("last"))
    load = utc(load_ts).strftime("%Y%m%dT%H%M%S%f")
    written = _folded(rows).withColumn("load", F.lit(load)).repartition("event_id").sortWithinPartitions("event_id")
    written.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(root)


def of_keys(spark: SparkSession, root: str, until=None) -> DataFrame:
    """event_id, deliveries, first and last of every key, as of the load at ``until`` if given. ``first`` gave an inserted
    row its source, ``last`` an updated one its values; under the ignoring policy ``first`` gave all of it."""
    rows = spark.read.schema(TABLE).parquet(root)
    if until is not None:
        rows = rows.where(F.col("load") <= utc(until).strftime("%Y%m%dT%H%M%S%f"))
    return _folded(rows)


def _page(place: str) -> Column:
    return F.struct(*[F.col(f"{place}.{c}").alias(c) for c in ("window_start", "window_end", "page")])


def _pages(staging: DataFrame, keys: DataFrame, place: str) -> DataFrame:
    """Events per grain and page. Both sides of the join have a row per key, so no key of it is hot; a grain or page with a
    third of all events is combined before its shuffle."""
    dated = staging.select("event_id", "device_id", F.to_date("event_timestamp").alias("metric_date"), "event_type")
    told = keys.select("event_id", _page(place).alias("delivered"), "deliveries")
    return (
        dated.join(told, "event_id", "left")
        .groupBy(*GRAIN, "delivered")
        .agg(F.count("*").alias("events"), F.sum("deliveries").alias("deliveries"))
    )


def behind(staging: DataFrame, keys: DataFrame, place: str = "last") -> DataFrame:
    """The pages behind each row of the fact, as rows: grain, window, page and the number of its events that
    the page delivered ``last`` (or ``first``). Restrict ``staging`` to ask for some rows of the fact only."""
    rows = _pages(staging, keys, place).where(F.col("delivered").isNotNull())
    return rows.select(*GRAIN, "delivered.*", "events")


def fact_lineage(staging: DataFrame, keys: DataFrame, place: str = "last") -> DataFrame:
    """One row per row of the fact, of fixed size: ``pages`` (their number), the first and last of them in the order of
    windows and pages, ``deliveries`` of its events in all loads, ``untraced`` events of which no page is known,
    and ``pages_digest``, which is equal for equal sets of pages and seldom else: the sum of 32 bits of each page's
    md5. The set itself is in ``behind``. Pages are counted by (grain, page) first, so no set is held."""
    page = F.concat_ws("/", "delivered.window_start", "delivered.window_end", F.col("delivered.page").cast("string"))
    number = F.conv(F.left(F.md5(page), F.lit(_DIGITS)), 16, 10).cast("bigint")
    known = F.col("delivered").isNotNull()
    found = _pages(staging, keys, place).groupBy(*GRAIN).agg(
        F.count_if(known).alias("pages"),
        F.min("delivered").alias("first"),
        F.max("delivered").alias("last"),
        F.sum("events").alias("events"),
        F.coalesce(F.sum("deliveries"), F.lit(0)).alias("deliveries"),
        F.coalesce(F.sum(F.when(~known, F.col("events"))), F.lit(0)).alias("untraced"),
        F.sum(F.when(known, number)).alias("pages_digest"),
    )
    ends = [F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in ("window_start", "page")]
    return found.select(*GRAIN, "events", "deliveries", "untraced", "pages", *ends, "pages_digest")
