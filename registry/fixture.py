"""The ``events`` table read as device telemetry. Every function maps rows one to one
(or one to a few), without a shuffle, and reads the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.session import configure

# The clock of the registered queries, and the time their rows were first loaded.
AS_OF = "2024-01-26 12:00:00"
LOADED = "2024-01-25 00:00:00"
RELOADED = "2024-01-26 00:00:00"
SOURCE = "https://api.example.com/telemetry"
# A clock after the seed rows, whose days are in February.
SEEDED = "2024-02-03 00:00:00"
SECRET = b"the key of the registered queries"

MODELS = ("Kite 2", "Kite 3", "Heron", "Wren Mini")
SYSTEMS = ("os-a 4", "os-a 5", "os-b 11", "os-b 12")
COUNTRIES = ("Chile", "Kenya", "Japan", "Iceland")
CITIES = ("Arica", "Kisumu", "Sapporo", "Akureyri")
EVENT_TYPES = {
    "view": "page_view",
    "click": "button_click",
    "purchase": "api_call",
    "error": "error",
    "signup": "signup",  # not an accepted type, on purpose
}
# Two days earlier than in the table, so that both time bounds of staging remove rows.
SHIFT = "interval 2 days"


def _pick(values, index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat telemetry columns plus the source columns ``n`` (event number) and ``user``."""
    events = configure(spark).read.parquet(f"{sf_dir}/events.parquet")
    types = " ".join(f"when '{k}' then '{v}'" for k, v in EVENT_TYPES.items())
    return events.selectExpr(
        "event_id as n",
        "user_id as user",
        "concat('evt_', event_id) as event_id",
        "concat('device_', user_id) as device_id",
        f"case event_type {types} end as event_type",
        f"cast(ts as timestamp) - {SHIFT} as timestamp",
        f"{_pick(MODELS, 'event_id % 4')} as device_model",
        f"{_pick(SYSTEMS, '(event_id div 4) % 4')} as os_version",
        "'7.0.3' as app_version",
        "concat('user_', user_id) as user_id",
        "concat('session_', event_id % 100) as session_id",
        f"if(event_id % 13 = 0, null, {_pick(COUNTRIES, 'user_id % 4')}) as country",
        f"if(event_id % 13 = 0, null, {_pick(CITIES, 'user_id % 4')}) as city",
        "if(event_id % 17 = 0, null, cast(value as decimal(18,2))) as metric_value",
        "100 + 29 * cast(get_json_object(props, '$.k') as int) as duration_ms",
    )


PAYLOAD = (
    "device_model",
    "os_version",
    "app_version",
    "user_id",
    "session_id",
    "country",
    "city",
    "metric_value",
    "duration_ms",
)


def raw(rows: DataFrame, *extra: str) -> DataFrame:
    """Telemetry rows as raw-table rows loaded at ``LOADED``."""
    return rows.select(
        "event_id",
        "device_id",
        "event_type",
        "timestamp",
        F.to_variant_object(F.struct(*PAYLOAD)).alias("payload"),
        F.expr("if(n % 3 = 0, 'seed_data', 'second_pull')").alias("source_api"),
        # Ingestion trails the event by up to ten minutes.
        (F.col("timestamp") + F.expr("make_dt_interval(0, 0, cast(n % 10 as int), 0)")).alias(
            "ingestion_timestamp"
        ),
        F.lit(LOADED).cast("timestamp").alias("created_at"),
        *extra,
    )


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(telemetry(spark, sf_dir))


def dirty_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with missing required values and repeated event ids, as a table without
    constraints may hold them."""
    rows = telemetry(spark, sf_dir)
    return raw(
        rows.withColumns(
            {
                "event_id": F.expr(
                    "case when n % 211 = 210 then concat('evt_', n - 1)"
                    " when n % 109 = 0 then null else event_id end"
                ),
                "device_id": F.expr("if(n % 101 = 0, null, device_id)"),
                "event_type": F.expr("if(n % 103 = 0, null, event_type)"),
                "timestamp": F.expr("if(n % 107 = 0, null, timestamp)"),
            }
        )
    )


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event again, as a batch on top of ``raw_table``: three rows to a key, some keys
    known and some new, device, time and payload all moved. ``n`` is the order."""
    rows = telemetry(spark, sf_dir).withColumns(
        {
            "event_id": F.expr("concat('evt_', 5 * (n div 3))"),
            "device_id": F.expr("concat('device_', user + n % 2)"),
            "timestamp": F.expr("timestamp + interval 1 day"),
            "city": F.expr("concat('city_', n)"),
        }
    )
    return raw(rows, "n").drop("created_at")


def late_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once more: those of the last days corrected in place (other device, two days
    back), all others as new events on five days of the middle of the month, but for a few from
    devices whose clocks are thousands of years ahead."""
    recent = "timestamp >= timestamp'2024-01-20 00:00:00'"
    moved = "make_dt_interval(cast(n % 5 as int), cast(n % 24 as int), cast(n % 60 as int), 0)"
    rows = telemetry(spark, sf_dir).withColumns(
        {
            "device_id": F.expr(f"if({recent}, concat('device_', user + 1), device_id)"),
            "event_id": F.expr(f"if({recent}, event_id, concat('late_', n))"),
            "timestamp": F.expr(
                f"case when {recent} then timestamp - interval 2 days"
                " when n % 97 = 5 then make_timestamp(9999, 12, 31, 23, 59, 59)"
                " when n % 97 = 6 then make_timestamp(12024, 1, 1, 0, 0, 0)"
                f" else timestamp'2024-01-10 00:00:00' + {moved} end"
            ),
        }
    )
    return raw(rows, "n").drop("created_at")


# Events per pull window of ``pages``; each event has its own page.
WINDOW = 1000


def _json(**changed: str) -> str:
    """SQL for an event as a JSON object; NULL columns are absent keys."""
    names = ("event_id", "device_id", "event_type", "timestamp", "source_api", *PAYLOAD)
    items = [f"{changed.get(name, name)} as {name}" for name in names]
    return f"to_json(struct({', '.join(items)}))"


def _document(events: str, has_more: str) -> str:
    """SQL for a page envelope; a final page leaves the pagination out."""
    more = f"if({has_more}, ',\"pagination\":{{\"has_more\":true}}', '')"
    return f"concat('{{\"data\":[', {events}, ']', {more}, '}}')"


def _place(rows: DataFrame, document: str, page: str) -> DataFrame:
    hours = f"make_dt_interval(0, cast(n div {WINDOW} as int) + {{}}, 0, 0)"
    label = "date_format(timestamp'2024-01-01 00:00:00' + {}, \"yyyy-MM-dd'T'HH:mm:ss\")"
    return rows.selectExpr(
        f"{label.format(hours.format(0))} as window_start",
        f"{label.format(hours.format(1))} as window_end",
        f"{page} as page",
        f"{document} as document",
    )


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry with the columns as an API would print them."""
    return telemetry(spark, sf_dir).withColumns(
        {
            "timestamp": F.expr("date_format(timestamp, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\")"),
            "source_api": F.expr("if(n % 2 = 0, 'mobile', null)"),
        }
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed pages: each event, every third one followed by its own correction.

    A page has one or two events whatever the data, so no group has to be
    collected to build it. Every fifth event gives an explicit null source.
    """
    correction = _json(
        device_id="concat('device_', user + 1)",
        event_type="'error'",
        source_api="'corrected'",
        city="concat('city_', n)",
        metric_value="cast(n as decimal(18,2))",
    )
    with_null = "concat(left(sent, length(sent) - 1), ',\"source_api\":null}')"
    rows = (
        _texts(spark, sf_dir)
        .withColumns({"sent": F.expr(_json()), "fixed": F.expr(correction)})
        .withColumn("sent", F.expr(f"if(n % 5 = 1, {with_null}, sent)"))
        .withColumn("sent", F.expr("if(n % 3 = 0, concat(sent, ',', fixed), sent)"))
    )
    return _place(rows, _document("sent", f"n % {WINDOW} < {WINDOW - 1}"), f"n % {WINDOW} + 1")


TWO_WINDOWS = (("2024-01-01T00:00:00", "2024-01-02T00:00:00"), ("2024-01-02T00:00:00", "2024-01-03T00:00:00"))


def two_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of ``pages`` as those of two windows: the odd ones, then the even ones."""
    sides = [" when ".join(["", *[f"page % 2 = {1 - i} then '{w[side]}'" for i, w in enumerate(TWO_WINDOWS)]]) for side in (0, 1)]
    return pages(spark, sf_dir).withColumns(
        {name: F.expr(f"case{side} end") for name, side in zip(("window_start", "window_end"), sides, strict=True)}
    )


def broken_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which every fourth window starts at page 2 and every fourth has no last page."""
    rows = _texts(spark, sf_dir)
    more = f"n % {WINDOW} < {WINDOW - 1} or (n div {WINDOW}) % 4 = 3"
    page = f"n % {WINDOW} + if((n div {WINDOW}) % 4 = 2, 2, 1)"
    rows = rows.withColumn("sent", F.expr(_json()))
    return _place(rows, _document("sent", more), page)


def broken_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with every kind of rule broken somewhere."""
    rows = _texts(spark, sf_dir)
    event = _json(
        event_id="case when n % 53 = 0 then repeat('e', 256) when n % 59 = 0 then null else event_id end",
        device_id="case when n % 61 = 0 then repeat('d', 101) when n % 67 = 0 then null else device_id end",
        event_type="case when n % 71 = 0 then repeat('t', 51) when n % 73 = 0 then null else event_type end",
        timestamp="case when n % 79 = 0 then 'nope' when n % 83 = 0 then null"
        " when n % 89 = 0 then '12:00' else timestamp end",
        source_api="case when n % 97 = 0 then repeat('s', 101) else source_api end",
    )
    listed = f"if(n % 101 = 0, '\"text\"', {event})"
    rows = rows.withColumn("sent", F.expr(listed)).withColumn(
        "document", F.expr(_document("sent", f"n % {WINDOW} < {WINDOW - 1}"))
    )
    cut = "if(n % 103 = 0, left(document, length(document) - 2), document)"
    return _place(rows, cut, f"n % {WINDOW} + 1")
