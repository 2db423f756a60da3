"""What may leave the team: events under tokens, and daily counts of which none is of fewer than k users."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drumlin.functions.masking import masked
from drumlin.session import write_scratch

#: Ids of the staging view, and their kinds.
IDS = {"event_id": "event", "device_id": "device", "user_id": "user", "session_id": "session"}
#: Columns that would tell who it was: whole payloads, and the finer place.
DROPPED = ("raw_payload", "city")
#: From fine to coarse: what a group of the masked fact may be told by.
LEVELS = (
    ("metric_date", "event_type", "device_model", "os_version", "country"),
    ("metric_date", "event_type", "device_model", "os_version"),
    ("metric_date", "event_type", "device_model"),
    ("metric_date", "event_type"),
    ("metric_date",),
)
LEAST_USERS = 5


def masked_events(staging: DataFrame, key: DataFrame) -> DataFrame:
    """The staging view for others: tokens for ids, times cut to the hour, no payload and no city."""
    hours = {c: F.date_trunc("hour", c) for c in ("event_timestamp", "ingestion_timestamp")}
    return masked(staging.drop(*DROPPED), key, IDS).withColumns(hours)


def small_groups(rows: DataFrame, by: Sequence[str], k: int = LEAST_USERS, user: str = "user_id") -> DataFrame:
    """Groups of a table in which fewer than ``k`` users are seen, with that number; none if it may be shown.
    Rows without a user count as no user. Users are counted by (group, user) first, so no set is held."""
    seen = rows.groupBy(*by, user).agg(F.lit(1).alias("one"))
    return seen.groupBy(*by).agg(F.count(user).alias("users")).where(F.col("users") < k)


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("event_count", "total_duration_ms", "total_metric_value")]


def masked_fact(staging: DataFrame, work: str, k: int = LEAST_USERS, levels=LEVELS) -> DataFrame:
    """Daily counts by ``levels[0]``; groups of fewer than ``k`` users join the next coarser group.

    Each event counts in one group: the finest whose events, less those of finer groups shown, are of ``k`` users
    or more. ``level`` says which, and columns it leaves out are null. Events that no level can show are the rows of
    level ``len(levels)``, one a day at most, of which nothing but their number is told.

    Only rows of groups that are too small go on to the next level; a hot group is shown at the first. They
    are written below ``work`` (shared scratch, the caller's to discard), so no level is computed twice."""
    spark = staging.sparkSession
    rows = staging.withColumn("metric_date", F.to_date("event_timestamp"))
    left = rows.groupBy(*levels[0], "user_id").agg(
        F.count("*").alias("event_count"),
        F.sum(F.col("duration_ms").cast("bigint")).alias("total_duration_ms"),
        F.sum("metric_value").cast("decimal(38,18)").alias("total_metric_value"),
    )
    shown = []
    finest = {c: left.schema[c].dataType for c in levels[0]}

    def as_row(frame: DataFrame, level: int, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
        names = ("users", "event_count", "total_duration_ms", "total_metric_value")
        kinds = dict(zip(names, ("bigint", "bigint", "bigint", "decimal(38,18)"), strict=True))
        return frame.select(
            F.lit(level).alias("level"),
            *[(F.col(c) if c in by else F.lit(None)).cast(kind).alias(c) for c, kind in finest.items()],
            *[(F.col(c) if c in measures else F.lit(None)).cast(kinds[c]).alias(c) for c in names],
        )

    for level, by in enumerate(levels):
        left = write_scratch(left, f"{work}/level-{level}")
        groups = left.groupBy(*by).agg(F.count("user_id").alias("users"), *_sums())
        measures = ("users", "event_count", "total_duration_ms", "total_metric_value")
        shown.append(as_row(groups.where(F.col("users") >= k), level, by, measures))
        small = groups.where(F.col("users") < k).select(*[F.col(c).alias(f"small_{c}") for c in by])
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"small_{c}")) for c in by])
        coarser = levels[level + 1] if level + 1 < len(levels) else by
        left = left.join(small, same, "left_semi").groupBy(*coarser, "user_id").agg(*_sums())
    withheld = write_scratch(left, f"{work}/withheld").groupBy(*levels[-1]).agg(F.sum("event_count").alias("event_count"))
    shown.append(as_row(withheld, len(levels), levels[-1], ("event_count",)))
    return reduce(DataFrame.unionByName, shown)
