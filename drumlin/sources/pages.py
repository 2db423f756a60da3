"""Landed API pages: the documents of a pull window, one JSON envelope per page.

Two landings are read. ``read_page_files`` takes one file per page. A pull of
billions of events should land as a table with many documents per file
(``read_page_table``), which spares the driver the listing of tiny files.
"""

from __future__ import annotations

from datetime import datetime, time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.functions.clock import utc

PAGE_FILE = r"(\d+)\.json$"
PAGES = "window_start string, window_end string, page bigint, document string"
# The order in which the pull delivered the events.
ORDER = ("window_start", "window_end", "page", "pos")


def from_text(lines: DataFrame) -> DataFrame:
    """Whole page files, batch or stream, as rows of ``PAGES``."""
    number = F.regexp_extract(F.col("_metadata.file_name"), PAGE_FILE, 1)
    return lines.select(
        "window_start",
        "window_end",
        number.cast("bigint").alias("page"),
        F.col("value").alias("document"),
    )


def read_page_files(spark: SparkSession, landing: str) -> DataFrame:
    """``landing/window_start=S/window_end=E/page-000001.json``, one page per file."""
    schema = "value string, window_start string, window_end string"
    return from_text(spark.read.schema(schema).text(landing, wholetext=True))


def read_page_table(spark: SparkSession, landing: str) -> DataFrame:
    """A Parquet landing with the columns of ``PAGES``."""
    return spark.read.schema(PAGES).parquet(landing)


def window_texts(value: datetime | str) -> list[str]:
    """The forms in which a landing may name an instant."""
    moment = utc(value).replace(tzinfo=None)
    plain = {moment.isoformat(), moment.isoformat(timespec="milliseconds"), moment.isoformat(sep=" ")}
    named = {f"{text}{zone}" for text in plain for zone in ("", "Z", "+00:00")}
    if moment.time() == time():
        named.add(moment.date().isoformat())
    return sorted(named)


def is_window(start, end) -> Column:
    """Whether a page belongs to the window, however its landing writes the two instants."""
    start_column, end_column = F.col("window_start"), F.col("window_end")
    named = start_column.isin(*window_texts(start)) & end_column.isin(*window_texts(end))
    return start_column.isNotNull() & end_column.isNotNull() & named


def in_window(pages: DataFrame, start, end) -> DataFrame:
    """Pages of one pull window; a partition filter when the landing is laid out by window."""
    return pages.filter(is_window(start, end))


def decode(pages: DataFrame) -> DataFrame:
    """Envelope parts per page: ``page_ok``, ``data`` and ``has_more``.

    A missing ``data`` is an empty page, a missing ``pagination`` or
    ``has_more`` means false. Anything that is no such envelope is not ok.
    """
    parsed = pages.withColumn("doc", F.expr("try_parse_json(document)"))
    data = F.try_variant_get("doc", "$.data", "array<variant>")
    no_data = F.variant_get("doc", "$.data", "variant").isNull()
    pagination = F.try_variant_get("doc", "$.pagination", "map<string,variant>")
    no_pagination = F.variant_get("doc", "$.pagination", "variant").isNull()
    page_ok = (
        F.col("doc").isNotNull()
        & F.startswith(F.ltrim("document"), F.lit("{"))
        & (data.isNotNull() | no_data)
        & (pagination.isNotNull() | no_pagination)
    )
    return parsed.select(
        "window_start",
        "window_end",
        "page",
        F.coalesce(page_ok, F.lit(False)).alias("page_ok"),
        data.alias("data"),
        F.coalesce(
            F.try_variant_get("doc", "$.pagination.has_more", "boolean"), F.lit(False)
        ).alias("has_more"),
    )


def events(pages: DataFrame) -> DataFrame:
    """One row per event in delivery order.

    An empty page gives one row without ``pos`` so that it still counts as
    delivered; a bad page gives one row with ``page_ok`` false.
    """
    # The outer form: for the inner one Catalyst adds a not-empty filter that parses again.
    return decode(pages).select(
        "window_start",
        "window_end",
        "page",
        "page_ok",
        "has_more",
        F.posexplode_outer("data").alias("pos", "event"),
    )


def is_event() -> Column:
    return F.col("pos").isNotNull()


def page_flags(rows: DataFrame) -> DataFrame:
    """One row per page document from rows of ``events`` or of the shaped batch."""
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    return rows.filter(first).select("window_start", "window_end", "page", "has_more")


def completeness(flags: DataFrame) -> DataFrame:
    """Per window: are the pages 1..n there once each, and does only page n say it is the last?

    ``flags`` has one row per page document, from ``page_flags`` or ``decode``.
    """
    per_page = flags.groupBy("window_start", "window_end", "page").agg(
        F.count(F.lit(1)).alias("copies"), F.bool_or("has_more").alias("has_more")
    )
    per_window = per_page.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("pages"),
        F.min("page").alias("first_page"),
        F.max("page").alias("last_page"),
        F.max("copies").alias("max_copies"),
        F.count_if(~F.col("has_more")).alias("final_pages"),
        F.max(F.when(~F.col("has_more"), F.col("page"))).alias("final_page"),
    )
    complete = (
        (F.col("first_page") == 1)
        & (F.col("last_page") == F.col("pages"))
        & (F.col("max_copies") == 1)
        & (F.col("final_pages") == 1)
        & (F.col("final_page") == F.col("last_page"))
    )
    return per_window.withColumn("complete", F.coalesce(complete, F.lit(False)))
