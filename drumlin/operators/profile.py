"""Small reports over the tables: counts, columns, freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.functions.keys import now


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``. An unreadable table raises instead of counting as 0."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def column_profile(
    spark: SparkSession, schema: T.StructType, defaults: Mapping[str, str] | None = None
) -> DataFrame:
    """Name, type, nullability and default in column order, from the table's contract.

    Parquet reports every column as nullable, so the stored schema cannot say.
    """
    defaults = defaults or {}
    rows = [
        (position, f.name, f.dataType.simpleString(), f.nullable, defaults.get(f.name))
        for position, f in enumerate(schema, start=1)
    ]
    columns = "ordinal_position int, name string, type string, nullable boolean, `default` string"
    return spark.createDataFrame(rows, columns)


def column_fill(df: DataFrame) -> DataFrame:
    """Rows and NULLs per column, from one scan."""
    names = df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(name).isNull()).alias(name) for name in names],
    )
    entries = [
        F.struct(
            F.lit(position).alias("ordinal_position"),
            F.lit(name).alias("name"),
            F.col("__rows").alias("row_count"),
            F.col(name).alias("null_count"),
        )
        for position, name in enumerate(names, start=1)
    ]
    return row.select(F.inline(F.array(*entries)))


def freshness(raw: DataFrame, as_of=None) -> DataFrame:
    """Rows ingested in the last hour and the newest ingestion time."""
    recent = F.col("ingestion_timestamp") > now(as_of) - F.expr("interval 1 hour")
    return raw.filter(recent).agg(
        F.count(F.lit(1)).alias("recent_events"),
        F.max("ingestion_timestamp").alias("last_ingestion"),
    )


def daily_type_summary(fact: DataFrame, as_of=None) -> DataFrame:
    """Today's fact rows and average duration per event type."""
    today = F.col("metric_date") == F.to_date(now(as_of))
    return (
        fact.filter(today)
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("fact_rows"),
            F.avg("avg_duration_ms").alias("avg_duration_ms"),
        )
    )


def load_check(raw: DataFrame, source: str, status: str) -> DataFrame:
    """A status label and the number of rows from one source."""
    return raw.filter(F.col("source_api") == source).agg(
        F.lit(status).alias("status"), F.count(F.lit(1)).alias("seed_records")
    )
