"""Distinct counts and modes of several columns, without per-group state.

``count(distinct)`` and ``mode`` in one aggregate keep a set or map per group,
so a group with a third of all rows and as many sessions would have to fit in
one task. Here three aggregations follow each other, all combining before
their shuffle and all but the last with fixed-width buffers:

1. events of equal grain, session, user and attributes become one row;
2. each such row becomes one narrow row per facet (session, user, model,
   system, country), and these are summed by grain, facet and value, which
   spreads a hot group over its values;
3. the values of a grain are folded into its counts and modes.

The first step costs one shuffle and saves five rows for every event that
repeats a combination elsewhere in the table.

That spreading is for hot groups. If the largest group fits in one task, rows are
dealt by grain once (``dealt``) and all three aggregations run where they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Facet 0 also carries the measures, and so keeps its NULL values.
FACETS = ("session_id", "user_id", "device_model", "os_version", "country")
MEASURES = {
    "first_time": "timestamp",
    "last_time": "timestamp",
    "duration_sum": "bigint",
    "duration_count": "bigint",
    "metric_sum": "decimal(38,18)",
    "metric_count": "bigint",
}

# Rows of a group that one task may get. Its aggregations sort or spill, so this bounds time, not memory.
ONE_TASK = 100_000


def dealt(rows: DataFrame, grain: Sequence[str], most: int = ONE_TASK) -> DataFrame:
    """The rows dealt by grain, if no group has more than ``most`` of them; else as they are.

    Groups are counted first, from the columns of the grain alone."""
    sizes = rows.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) > most:
        return rows
    return rows.repartition(*grain)


def combinations(rows: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Events and measures per grain and combination of facet values."""
    return rows.groupBy(*grain, *FACETS).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("event_timestamp").alias("first_time"),
        F.max("event_timestamp").alias("last_time"),
        F.sum("duration_ms").alias("duration_sum"),
        F.count("duration_ms").alias("duration_count"),
        F.sum("metric_value").alias("metric_sum"),
        F.count("metric_value").alias("metric_count"),
    )


def _facet_rows(combined: DataFrame, grain: Sequence[str]) -> DataFrame:
    def entry(number: int, column: str) -> Column:
        measures = [
            (F.col(name) if number == 0 else F.lit(None)).cast(kind).alias(name)
            for name, kind in MEASURES.items()
        ]
        return F.struct(F.lit(number).alias("facet"), F.col(column).alias("value"), *measures)

    entries = F.array(*[entry(number, column) for number, column in enumerate(FACETS)])
    exploded = combined.select(*grain, "events", F.inline(entries))
    return exploded.filter((F.col("facet") == 0) | F.col("value").isNotNull())


def value_counts(rows: DataFrame, grain: Sequence[str]) -> DataFrame:
    """One row per grain, facet and value, with the measures on facet 0."""
    return by_value(combinations(rows, grain), grain)


def by_value(combined: DataFrame, grain: Sequence[str]) -> DataFrame:
    """The same of combinations, of which there may be several rows each."""
    sums = ("events", "duration_sum", "duration_count", "metric_sum", "metric_count")
    return (
        _facet_rows(combined, grain)
        .groupBy(*grain, "facet", "value")
        .agg(
            F.min("first_time").alias("first_time"),
            F.max("last_time").alias("last_time"),
            *[F.sum(name).alias(name) for name in sums],
        )
    )


def _in(facet: str) -> Column:
    return F.col("facet") == FACETS.index(facet)


def mode(facet: str) -> Column:
    """The most frequent value, ties going to the smallest; NULL if there is none."""
    best = F.struct((-F.col("events")).alias("rank"), F.col("value"))
    return F.min(F.when(_in(facet) & F.col("value").isNotNull(), best))["value"]


def distinct(facet: str) -> Column:
    return F.count(F.when(_in(facet), F.col("value")))


def event_count() -> Column:
    return F.sum(F.when(F.col("facet") == 0, F.col("events")))
