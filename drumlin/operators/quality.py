"""Column tests as data, evaluated to one row per rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drumlin.contract import EVENT_TYPES

RAW, STAGING, FACT, DEVICES = (
    "telemetry_events",
    "stg_telemetry__raw",
    "fct_telemetry_metrics",
    "dim_devices",
)


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    kind: str  # not_null, unique, accepted_values or relationships
    values: tuple[str, ...] = ()
    parent: str = ""  # relationships: the model whose same-named column must hold the value


# The twelve declared column tests.
RULES = (
    Rule(RAW, "event_id", "unique"),
    Rule(RAW, "event_id", "not_null"),
    Rule(RAW, "device_id", "not_null"),
    Rule(RAW, "event_type", "not_null"),
    Rule(STAGING, "event_id", "unique"),
    Rule(STAGING, "event_id", "not_null"),
    Rule(STAGING, "event_type", "accepted_values", EVENT_TYPES),
    Rule(FACT, "metric_id", "unique"),
    Rule(FACT, "metric_id", "not_null"),
    Rule(FACT, "event_count", "not_null"),
    Rule(DEVICES, "device_id", "unique"),
    Rule(DEVICES, "device_id", "not_null"),
)
# Described in the documents, declared nowhere: every fact row has its device.
REFERENTIAL = Rule(FACT, "device_id", "relationships", parent=DEVICES)


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of not_null."""
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Failing rows of unique: each repeated value with its row count."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.filter("n > 1")


def unaccepted_values(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Failing rows of accepted_values: each foreign value with its row count."""
    foreign = df.filter(~F.col(column).isin(*values))
    return foreign.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Values of the child that no parent row has, with their row count.

    Both sides are reduced to one row per value first, so the join cannot skew.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column)
    known = parent.select(column).distinct()
    return values.agg(F.count(F.lit(1)).alias("n")).join(known, column, "left_anti")


def _result(failing: DataFrame, rule: Rule, failures) -> DataFrame:
    return failing.agg(F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit(rule.model).alias("model"),
        F.lit(rule.column).alias("column"),
        F.lit(rule.kind).alias("rule"),
        "failures",
    )


def _not_null(df: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """All not_null rules of a model from one scan."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("failures"))
        for c in columns
    ]
    return row.select(F.inline(F.array(*entries))).select(
        F.lit(model).alias("model"), "column", F.lit("not_null").alias("rule"), "failures"
    )


def evaluate(models: Mapping[str, DataFrame], rules: Iterable[Rule] = RULES) -> DataFrame:
    """``(model, column, rule, failures, passed)``, one row per rule."""
    rules = list(rules)
    parts = []
    for model in dict.fromkeys(rule.model for rule in rules):
        columns = [r.column for r in rules if r.model == model and r.kind == "not_null"]
        if columns:
            parts.append(_not_null(models[model], model, columns))
    for rule in rules:
        df = models[rule.model]
        if rule.kind == "unique":
            parts.append(_result(repeated_values(df, rule.column), rule, F.count(F.lit(1))))
        elif rule.kind == "accepted_values":
            failing = unaccepted_values(df, rule.column, rule.values)
            parts.append(_result(failing, rule, F.count(F.lit(1))))
        elif rule.kind == "relationships":
            failing = orphans(df, models[rule.parent], rule.column)
            parts.append(_result(failing, rule, F.sum("n")))
        elif rule.kind != "not_null":
            raise ValueError(f"unknown rule kind: {rule.kind}")
    results = reduce(DataFrame.unionByName, parts)
    return results.withColumn("passed", F.col("failures") == 0)
