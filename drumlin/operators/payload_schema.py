"""What keys payloads hold, of which types and since when; and how that differs from a contract."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drumlin.contract import TEXT_KEYS

#: Levels of nested objects that are looked into.
DEPTH = 3
#: From narrow to wide; numbers widen into each other, other types that meet are ``mixed``.
NUMBERS = ("integer", "decimal", "double")
#: What the staging view expects of a payload.
EXPECTED = {**dict.fromkeys(TEXT_KEYS, "text"), "metric_value": "decimal", "duration_ms": "integer"}
NEW, MISSING, WIDENED, NARROWED, CHANGED, SAME = "new", "missing", "widened", "narrowed", "changed", "same"


def kind(value: Column) -> Column:
    """Type of a variant without its parameters."""
    full = F.regexp_extract(F.schema_of_variant(value), "^[A-Z_]+", 0)
    names = {"BIGINT": "integer", "DECIMAL": "decimal", "FLOAT": "double", "DOUBLE": "double", "STRING": "text", "VOID": "null"}
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(known, full), F.lower(full))


def merged(kinds: Column) -> Column:
    """The narrowest type that holds all the kinds in an array; nulls fit any type."""
    real = F.array_except(kinds, F.array(F.lit("null")))
    numbers = F.array(*[F.lit(x) for x in NUMBERS])
    only_numbers = (F.size(real) > 0) & (F.size(F.array_except(real, numbers)) == 0)
    widest = F.element_at(F.array_intersect(numbers, real), -1)
    return (
        F.when(F.size(real) == 0, F.lit("null"))
        .when(only_numbers, widest)
        .when(F.size(real) == 1, F.element_at(real, 1))
        .otherwise(F.lit("mixed"))
    )


def _entries(value: Column, prefix: Column) -> Column:
    """path and value of the keys of an object, none of anything else."""
    keys = F.coalesce(F.map_entries(F.try_variant_get(value, "$", "map<string,variant>")), F.array())
    return F.transform(keys, lambda e: F.struct(F.concat(prefix, e["key"]).alias("path"), e["value"].alias("value")))


def payload_schema(raw: DataFrame, depth: int = DEPTH) -> DataFrame:
    """path, type, present, nulls, share, first_day and last_day of every key of the payloads.

    Keys of nested objects are paths with dots, down to ``depth`` levels; what lies deeper or in arrays
    counts as part of its ``object`` or ``array``. ``share`` is of all rows, days are of the events that
    have one. A payload that is null or no object has no keys. Counts are combined before the one shuffle,
    by path and kind, so a key that every row holds is no hot group."""
    level = _entries(F.col("payload"), F.lit(""))
    found = level
    for _ in range(1, depth):
        level = F.flatten(F.transform(level, lambda e: _entries(e["value"], F.concat(e["path"], F.lit(".")))))
        found = F.concat(found, level)
    keys = raw.select(F.to_date("timestamp").alias("day"), F.explode(found).alias("e"))
    counted = keys.groupBy(F.col("e.path").alias("path"), kind(F.col("e.value")).alias("kind")).agg(
        F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
    rows = raw.agg(F.count("*").alias("rows"))
    return (
        counted.groupBy("path")
        .agg(
            merged(F.array_sort(F.collect_set("kind"))).alias("type"),  # a dozen kinds at most
            F.sum("n").alias("present"),
            F.sum(F.when(F.col("kind") == "null", F.col("n")).otherwise(0)).alias("nulls"),
            F.min("first_day").alias("first_day"),
            F.max("last_day").alias("last_day"),
        )
        .join(F.broadcast(rows))  # one row
        .select("path", "type", "present", "nulls", (F.col("present") / F.col("rows")).alias("share"), "first_day", "last_day")
    )


def drift(schema: DataFrame, expected: Mapping[str, str] = EXPECTED) -> DataFrame:
    """path, expected, type and status of each key that is in the payloads or in the contract. A key that
    holds nothing but nulls agrees with any type; a wider number is ``widened``, a narrower one ``narrowed``."""
    spark = schema.sparkSession
    contract = spark.createDataFrame(list(expected.items()), "path string, expected string")
    place = F.create_map(*[F.lit(x) for i, name in enumerate(NUMBERS) for x in (name, i)])
    now, then = F.try_element_at(place, F.col("type")), F.try_element_at(place, F.col("expected"))
    status = (
        F.when(F.col("expected").isNull(), NEW)
        .when(F.col("type").isNull(), MISSING)
        .when((F.col("type") == F.col("expected")) | (F.col("type") == "null"), SAME)
        .when(now > then, WIDENED)
        .when(now < then, NARROWED)
        .otherwise(CHANGED)
    )
    return schema.select("path", "type").join(contract, "path", "full").select("path", "expected", "type", status.alias("status"))
