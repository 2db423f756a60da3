"""Registered queries: the library's operators and jobs over the given ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drumlin.contract import GRAIN, RAW, RAW_DEFAULTS
from drumlin.functions import masking
from drumlin.operators import anomalies, profile, quality
from drumlin.operators import payload_schema as payloads
from drumlin.operators.shape import shape, violations
from drumlin.operators.upsert import IGNORE, NARROW, UPDATE, upsert
from drumlin.plans import daily_run, dimension, fact, fact_state, feed, history, lineage, load, masked, refresh
from drumlin.plans.staging import stage
from drumlin.session import ROW_GROUP, scratch, write_scratch
from drumlin.sources import pages
from drumlin.sources.seed import SEED_SOURCE, SEED_STATUS
from drumlin.streaming import fact as stream
from drumlin.streaming.load import load_stream, page_table_stream
from registry import fixture
from registry.fixture import AS_OF, LOADED, RELOADED, SECRET, SOURCE

Query = Callable[[SparkSession, str], DataFrame]


def _plain(df: DataFrame, run_time: bool = False) -> DataFrame:
    """Types every engine can compare: zone-free timestamps and rounded doubles. The time of the
    run stays if asked for: a refresh leaves that of an earlier run on the days it does not touch."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "timestamp":
            column = column.cast("timestamp_ntz")
        elif kind.startswith("decimal") or kind == "double":
            column = F.round(column.cast("double"), 6)
        columns.append(column.alias(name))
    plain = df.select(*columns)
    return plain if run_time else plain.drop("dbt_updated_at")


def _raw_columns(raw: DataFrame) -> DataFrame:
    """A raw table with its payload spelt out."""
    payload = F.col("payload")
    keys = F.map_keys(payload.cast("map<string,variant>"))
    texts = [key for key in fixture.PAYLOAD if key not in ("metric_value", "duration_ms")]
    return _plain(
        raw.select(
            *[c for c in RAW.names if c != "payload"],
            *[F.variant_get(payload, f"$.{k}", "string").alias(k) for k in texts],
            F.variant_get(payload, "$.metric_value", "decimal(38,18)").alias("metric_value"),
            F.variant_get(payload, "$.duration_ms", "int").alias("duration_ms"),
            F.array_join(F.array_sort(keys), ",").alias("payload_keys"),
        )
    )


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(fixture.dirty_table(spark, sf_dir), AS_OF)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(fact.fact_daily(_staged(spark, sf_dir), AS_OF), run_time=True)


def stage_clean(spark, sf_dir):
    return _plain(_staged(spark, sf_dir).drop("raw_payload"))


def fact_mode_attributes(spark, sf_dir):
    return _fact(spark, sf_dir).select(*GRAIN, "device_model", "os_version", "country")


def fact_distinct_counts(spark, sf_dir):
    return _fact(spark, sf_dir).select(*GRAIN, "event_count", "unique_sessions", "unique_users")


def fact_duration_stats(spark, sf_dir):
    return _fact(spark, sf_dir).select(*GRAIN, "avg_duration_ms", "total_duration_ms")


def fact_value_stats(spark, sf_dir):
    return _fact(spark, sf_dir).select(*GRAIN, "avg_metric_value", "total_metric_value")


def surrogate_keys(spark, sf_dir):
    return _fact(spark, sf_dir).select("metric_id", *GRAIN)


def dim_devices(spark, sf_dir):
    return _plain(dimension.dim_devices(_staged(spark, sf_dir), AS_OF), run_time=True)


def dim_latest_attributes(spark, sf_dir):
    return dimension.latest_attributes(_staged(spark, sf_dir))


def dim_activity(spark, sf_dir):
    columns = ("first_seen_at", "last_seen_at", "total_events", "active_days", "days_active_span")
    return dim_devices(spark, sf_dir).select("device_id", *columns)


def dim_from_device_days(spark, sf_dir):
    days = dimension.device_days(_staged(spark, sf_dir))
    return _plain(dimension.from_device_days(days, AS_OF))


def _landed(documents: DataFrame) -> DataFrame:
    """The pages as a landed table, which is where a pull leaves them."""
    landing = scratch(documents.sparkSession, "landing")
    documents.write.option("parquet.block.size", ROW_GROUP).parquet(landing)
    return pages.read_page_table(documents.sparkSession, landing)


def raw_shape(spark, sf_dir):
    shaped = shape(pages.events(_landed(fixture.pages(spark, sf_dir))), SOURCE)
    return _raw_columns(shaped.withColumn("created_at", F.lit(None).cast("timestamp"))).drop(
        "created_at"
    )


def page_completeness(spark, sf_dir):
    arrived = _landed(fixture.broken_pulls(spark, sf_dir))
    return pages.completeness(pages.page_flags(pages.events(arrived)))


def load_violations(spark, sf_dir):
    shaped = shape(pages.events(_landed(fixture.broken_pages(spark, sf_dir))), SOURCE)
    return violations(shaped)


def _upsert(update) -> Query:
    def query(spark, sf_dir):
        table = upsert(
            fixture.raw_table(spark, sf_dir),
            fixture.batch(spark, sf_dir),
            key="event_id",
            update=update,
            order=["n"],
            defaults={"created_at": F.lit(RELOADED).cast("timestamp")},
        )
        return _raw_columns(table)

    return query


def dq_not_null(spark, sf_dir):
    raw = fixture.dirty_table(spark, sf_dir)
    columns = ("event_id", "device_id", "event_type")
    rules = [quality.Rule(quality.RAW, c, "not_null") for c in columns]
    return quality.evaluate({quality.RAW: raw}, rules)


def dq_unique(spark, sf_dir):
    return quality.repeated_values(fixture.dirty_table(spark, sf_dir), "event_id")


def dq_accepted_values(spark, sf_dir):
    return quality.unaccepted_values(_staged(spark, sf_dir), "event_type", quality.EVENT_TYPES)


def _models(spark, sf_dir) -> dict[str, DataFrame]:
    raw = fixture.dirty_table(spark, sf_dir)
    staging = stage(raw, AS_OF)
    return {
        quality.RAW: raw,
        quality.STAGING: staging,
        quality.FACT: fact.fact_daily(staging, AS_OF),
        quality.DEVICES: dimension.dim_devices(staging, AS_OF),
    }


def dq_suite(spark, sf_dir):
    return quality.evaluate(_models(spark, sf_dir))


def dq_relationships(spark, sf_dir):
    """Fact rows whose device is missing from a dimension built three days earlier."""
    facts = fact.fact_daily(_staged(spark, sf_dir), AS_OF)
    old = dimension.dim_devices(stage(fixture.dirty_table(spark, sf_dir), "2024-01-02 00:00:00"))
    return quality.orphans(facts, old, "device_id")


def freshness(spark, sf_dir):
    return _plain(profile.freshness(fixture.raw_table(spark, sf_dir), AS_OF))


def daily_type_summary(spark, sf_dir):
    facts = fact.fact_daily(_staged(spark, sf_dir), AS_OF)
    return _plain(profile.daily_type_summary(facts, AS_OF))


def seed_check(spark, sf_dir):
    return profile.load_check(fixture.raw_table(spark, sf_dir), SEED_SOURCE, SEED_STATUS)


def row_counts(spark, sf_dir):
    return profile.row_counts(_models(spark, sf_dir))


def column_profile(spark, sf_dir):
    contract = profile.column_profile(spark, RAW, RAW_DEFAULTS)
    fill = profile.column_fill(fixture.dirty_table(spark, sf_dir))
    return contract.join(fill, ["ordinal_position", "name"])


def _new_layout(spark: SparkSession) -> refresh.Layout:
    return refresh.Layout(scratch(spark, "registered"))


def load_batch(spark, sf_dir):
    """The whole load job: pages are checked, shaped and upserted into a new table."""
    layout = _new_layout(spark)
    arrived = _landed(fixture.pages(spark, sf_dir))
    load.load_pages(
        spark,
        arrived,
        layout.raw,
        default_source=SOURCE,
        load_ts=LOADED,
        require_complete=False,  # the last window ends where the table does
    )
    return _raw_columns(load.read_raw(spark, layout.raw))


def stream_load(spark, sf_dir):
    """The same load as a stream over a page table, in two calls between which pages land."""
    layout = _new_layout(spark)
    landing = f"{layout.root}/landing"
    arriving = fixture.pages(spark, sf_dir)
    for part in ("page % 2 = 0", "page % 2 = 1"):
        arriving.where(part).write.mode("append").parquet(landing)
        load_stream(
            page_table_stream(spark, landing),
            layout.raw,
            f"{layout.root}/checkpoint",
            default_source=SOURCE,
            load_ts=LOADED,
        )
    return _raw_columns(load.read_raw(spark, layout.raw))


def _load_again(update) -> Query:
    """A second load on top of a first, as the job runs it."""

    def query(spark, sf_dir):
        layout = _new_layout(spark)
        first = fixture.raw_table(spark, sf_dir)
        load.load_rows(spark, first, layout.raw, order=["event_id"], load_ts=LOADED)
        second = write_scratch(fixture.batch(spark, sf_dir), scratch(spark, "second"))
        load.load_rows(spark, second, layout.raw, order=["n"], load_ts=RELOADED, update=update)
        return _raw_columns(load.read_raw(spark, layout.raw))

    return query


def rejected_load(spark, sf_dir):
    """A bad batch on top of a good table: what it says, and the table as it stays."""
    layout = _new_layout(spark)
    first = fixture.raw_table(spark, sf_dir)
    load.load_rows(spark, first, layout.raw, order=["event_id"], load_ts=LOADED)
    arrived = _landed(fixture.broken_pages(spark, sf_dir))
    try:
        load.load_pages(spark, arrived, layout.raw, default_source=SOURCE, load_ts=RELOADED)
    except load.LoadRejected as rejected:
        said = (rejected.input_rows, rejected.rejected)
    stays = load.read_raw(spark, layout.raw).agg(F.count("*").alias("table_rows"), F.max("created_at").alias("newest"))
    return _plain(stays.withColumns({"input_rows": F.lit(said[0]).cast("bigint"), "rejected_rows": F.lit(said[1]).cast("bigint")}))


def gate_failed(spark, sf_dir):
    """Runs whose tests fail: published under one gate, not under the other."""
    found = None
    arrived = _landed(fixture.pages(spark, sf_dir))
    for gate in (daily_run.BEFORE, daily_run.AFTER):
        layout = _new_layout(spark)
        try:
            daily_run.daily_run(
                spark, arrived, layout, as_of=AS_OF, default_source=SOURCE, gate=gate, require_complete=False
            )
        except daily_run.QualityFailed as failed:
            models = ",".join(sorted({f"{row[0]}.{row[1]}" for row in failed.failed}))
        rows = refresh.read_fact(spark, layout).agg(F.count("*").alias("fact_rows"))
        rows = rows.select(F.lit(gate).alias("gate"), F.lit(models).alias("failed"), "fact_rows")
        found = rows if found is None else found.unionByName(rows)
    return found


def stage_counts(spark, sf_dir):
    """Rows at each stage of a second load on top of a first."""
    layout = _new_layout(spark)
    first = fixture.raw_table(spark, sf_dir)
    load.load_rows(spark, first, layout.raw, order=["event_id"], load_ts=LOADED)
    second = fixture.batch(spark, sf_dir)
    summary = load.load_rows(spark, second, layout.raw, order=["n"], load_ts=RELOADED)
    refresh.publish(spark, layout, refresh.build(spark, layout, AS_OF))
    frames = daily_run.models(spark, layout, AS_OF)
    return daily_run.stage_counts(summary, frames)


def daily_run_fact(spark, sf_dir):
    """The whole job from landed pages to published marts, tested before it publishes."""
    layout = _new_layout(spark)
    kept = [rule for rule in quality.RULES if rule.kind != "accepted_values"]
    daily_run.daily_run(
        spark,
        _landed(fixture.pages(spark, sf_dir)),
        layout,
        as_of=AS_OF,
        default_source=SOURCE,
        gate=daily_run.BEFORE,
        rules=[*kept, quality.REFERENTIAL],
        require_complete=False,
    )
    return _plain(refresh.read_fact(spark, layout))


def _refreshed(spark: SparkSession, sf_dir: str) -> refresh.Layout:
    """Marts built early on a first load, then refreshed for a second load and a later clock."""
    layout = _new_layout(spark)
    first = fixture.raw_table(spark, sf_dir)
    load.load_rows(spark, first, layout.raw, order=["event_id"], load_ts=LOADED)
    refresh.publish(spark, layout, refresh.build(spark, layout, "2024-01-24 06:00:00"))
    second = fixture.late_batch(spark, sf_dir)
    load.load_rows(spark, second, layout.raw, order=["n"], load_ts=RELOADED)
    refresh.publish(spark, layout, refresh.build(spark, layout, AS_OF))
    return layout


def fact_incremental(spark, sf_dir):
    return _plain(refresh.read_fact(spark, _refreshed(spark, sf_dir)))


def dim_incremental(spark, sf_dir):
    return _plain(refresh.read_devices(spark, _refreshed(spark, sf_dir)))


def _two_loads(spark: SparkSession, sf_dir: str, after=lambda layout: None) -> refresh.Layout:
    """A first load and a second one on top of it, each recorded in the change feed."""
    layout = _new_layout(spark)
    first, second = fixture.raw_table(spark, sf_dir), fixture.late_batch(spark, sf_dir)
    for rows, order, time in ((first, "event_id", LOADED), (second, "n", RELOADED)):
        load.load_rows(spark, rows, layout.raw, order=[order], load_ts=time)
        feed.record(spark, layout.raw)
        after(layout)
    return layout


def change_feed(spark, sf_dir):
    """What the second load changed, with both images."""
    rows = feed.read(spark, _two_loads(spark, sf_dir).raw, after=1)
    images = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("old", "new") for c in ("device_id", "created_at")]
    # Some devices' clocks are past the year 9999, for which Python has no date.
    images += [F.unix_micros(f"{side}.timestamp").alias(f"{side}_micros") for side in ("old", "new")]
    values = [
        F.variant_get(F.col(f"{side}.payload"), "$.metric_value", "decimal(38,18)").alias(f"{side}_metric_value") for side in ("old", "new")
    ]
    return _plain(rows.select("event_id", "op", *images, *values))


def raw_as_of(spark, sf_dir):
    """The raw table between the two loads, from the feed."""
    return _raw_columns(feed.raw_as_of(spark, _two_loads(spark, sf_dir).raw, "2024-01-25 12:00:00"))


def fact_by_deltas(spark, sf_dir):
    """The fact after two loads and a later clock, by corrected counts."""
    times = iter(("2024-01-24 06:00:00", AS_OF))
    layout = _two_loads(spark, sf_dir, lambda layout: fact_state.apply(spark, layout, next(times)))
    return _plain(fact_state.read_fact(spark, layout))


def dim_history(spark, sf_dir):
    """The device history after two loads, the second of which brings events late."""
    times = iter(("2024-01-24 06:00:00", AS_OF))
    layout = _two_loads(spark, sf_dir, lambda layout: history.refresh(spark, layout, next(times)))
    return _plain(history.read_history(spark, layout))


def stream_fact(spark, sf_dir):
    """The same by a stream; the second load changes days that are closed."""
    times = iter(("2024-01-25 06:00:00", AS_OF))
    layout = _two_loads(
        spark, sf_dir, lambda layout: stream.advance(spark, layout, f"{layout.root}/stream", next(times))
    )
    return _plain(stream.read_fact(spark, layout))


def payload_schema(spark, sf_dir):
    """Keys of the payloads, their types, shares and days."""
    return _plain(payloads.payload_schema(fixture.dirty_table(spark, sf_dir)))


def payload_drift(spark, sf_dir):
    """The same against a contract that is older than the data: no city yet, whole metrics, a key that went."""
    older = {k: v for k, v in payloads.EXPECTED.items() if k != "city"} | {"metric_value": "integer", "battery": "decimal"}
    return payloads.drift(payloads.payload_schema(fixture.dirty_table(spark, sf_dir)), older)


def metric_scores(spark, sf_dir):
    """Every day of the fact against the days before it."""
    return anomalies.scores(fact.fact_of_job(_staged(spark, sf_dir), AS_OF))


def metric_anomalies(spark, sf_dir):
    """The days that stand out, with their rank within event type and metric."""
    return anomalies.anomalies(fact.fact_of_job(_staged(spark, sf_dir), AS_OF), threshold=1.5)


def masked_events(spark, sf_dir):
    """The staging view under tokens."""
    return _plain(masked.masked_events(_staged(spark, sf_dir), masking.keys(spark, SECRET)))


def masked_fact(spark, sf_dir):
    """Daily counts of which none is of fewer than five users."""
    return _plain(masked.masked_fact(_staged(spark, sf_dir), scratch(spark, "masked")))


def small_groups(spark, sf_dir):
    """Groups of the staging view that would tell of fewer than five users."""
    dated = _staged(spark, sf_dir).withColumn("metric_date", F.to_date("event_timestamp"))
    return masked.small_groups(dated, ["metric_date", "event_type", "country"])


def _traced(spark: SparkSession, sf_dir: str) -> tuple[refresh.Layout, DataFrame]:
    """Two loads of landed pages, of the even pages and then of all; the lineage of their keys."""
    layout = _new_layout(spark)
    kept = f"{layout.root}/lineage"
    arrived = _landed(fixture.pages(spark, sf_dir))
    for part, time in ((arrived.where("page % 2 = 0"), LOADED), (arrived, RELOADED)):
        load.load_pages(
            spark, part, layout.raw, default_source=SOURCE, load_ts=time, require_complete=False, lineage_root=kept
        )
    return layout, lineage.of_keys(spark, kept)


def key_lineage(spark, sf_dir):
    """First and last delivery of each key."""
    keys = _traced(spark, sf_dir)[1]
    places = [F.col(f"{end}.{c}").alias(f"{end}_{c}") for end in ("first", "last") for c in ("loaded_at", "window_start", "page", "pos")]
    return _plain(keys.select("event_id", "deliveries", *places))


def fact_lineage(spark, sf_dir):
    """The pages behind each row of the fact, in fixed size."""
    layout, keys = _traced(spark, sf_dir)
    return lineage.fact_lineage(stage(load.read_raw(spark, layout.raw), AS_OF), keys)


def _viewed(spark: SparkSession, sf_dir: str) -> None:
    """A new table with its seed rows, two windows pulled one after the other, and all of it as SQL views."""
    layout, later = _new_layout(spark), fixture.SEEDED
    daily_run.initialise(spark, layout, load_ts=LOADED)
    arrived = _landed(fixture.two_windows(spark, sf_dir))
    for start, end in fixture.TWO_WINDOWS:
        load.load_pages(
            spark, pages.in_window(arrived, start, end), layout.raw,
            default_source=SOURCE, load_ts=RELOADED, require_complete=False,
        )
    refresh.publish(spark, layout, refresh.build(spark, layout, later))
    daily_run.register_views(spark, layout, later)


def view_staging(spark, sf_dir):
    """The staging view by SQL, seed rows included."""
    _viewed(spark, sf_dir)
    return _plain(spark.sql(
        """SELECT event_id, device_id, event_type, event_timestamp, source_api, device_model, os_version, user_id,
             session_id, country, city, metric_value, duration_ms FROM stg_telemetry__raw"""
    ))


def view_marts(spark, sf_dir):
    """The fact joined to the dimension by SQL."""
    _viewed(spark, sf_dir)
    return _plain(spark.sql(
        """SELECT device_id, d.device_model, d.total_events, sum(f.event_count) AS fact_events, count(*) AS fact_rows,
             max(f.metric_date) AS last_day
           FROM fct_telemetry_metrics f JOIN dim_devices d USING (device_id) GROUP BY ALL"""
    ))


QUERIES: dict[str, Query] = {
    "metric_scores": metric_scores,
    "metric_anomalies": metric_anomalies,
    "masked_events": masked_events,
    "masked_fact": masked_fact,
    "small_groups": small_groups,
    "key_lineage": key_lineage,
    "fact_lineage": fact_lineage,
    "view_staging": view_staging,
    "view_marts": view_marts,
    "payload_schema": payload_schema,
    "payload_drift": payload_drift,
    "change_feed": change_feed,
    "raw_as_of": raw_as_of,
    "fact_by_deltas": fact_by_deltas,
    "stream_fact": stream_fact,
    "dim_history": dim_history,
    "stage_clean": stage_clean,
    "fact_daily": _fact,
    "fact_mode_attributes": fact_mode_attributes,
    "fact_distinct_counts": fact_distinct_counts,
    "fact_duration_stats": fact_duration_stats,
    "fact_value_stats": fact_value_stats,
    "surrogate_keys": surrogate_keys,
    "dim_devices": dim_devices,
    "dim_latest_attributes": dim_latest_attributes,
    "dim_activity": dim_activity,
    "dim_from_device_days": dim_from_device_days,
    "raw_shape": raw_shape,
    "page_completeness": page_completeness,
    "load_violations": load_violations,
    "upsert_update": _upsert(UPDATE),
    "upsert_narrow": _upsert(NARROW),
    "upsert_ignore": _upsert(IGNORE),
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_accepted_values": dq_accepted_values,
    "dq_suite": dq_suite,
    "dq_relationships": dq_relationships,
    "freshness": freshness,
    "daily_type_summary": daily_type_summary,
    "seed_check": seed_check,
    "row_counts": row_counts,
    "column_profile": column_profile,
    "load_batch": load_batch,
    "load_again_update": _load_again(UPDATE),
    "load_again_narrow": _load_again(NARROW),
    "load_again_ignore": _load_again(IGNORE),
    "rejected_load": rejected_load,
    "gate_failed": gate_failed,
    "stream_load": stream_load,
    "stage_counts": stage_counts,
    "daily_run_fact": daily_run_fact,
    "fact_incremental": fact_incremental,
    "dim_incremental": dim_incremental,
}
