"""Events to raw rows, with the rules a row breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drumlin.contract import KNOWN_KEYS, MAX_LENGTH, REQUIRED
from drumlin.sources.pages import ORDER, is_event

# A timestamp names a full date; Spark alone would also take '2024' or '10:00'.
FULL_DATE = r"^\s*\d{4,}-\d{1,2}-\d{1,2}"


def _instant(text: str) -> Column:
    return F.when(F.col(text).rlike(FULL_DATE), F.col(text).try_cast("timestamp"))


def _nested(key: str) -> Column:
    """The key holds an object or array. The type is only looked up if its text could be one."""
    text = F.col(key)
    kind = F.schema_of_variant(F.variant_get("event", f"$.{key}", "variant"))
    return F.when(text.startswith("{") | text.startswith("["), kind.rlike("^(OBJECT|ARRAY)"))


def _rules() -> dict[str, Column]:
    is_object = F.col("payload").isNotNull()
    rules = {
        "malformed_page": ~F.col("page_ok"),
        "event_not_object": is_event() & ~is_object,
    }
    for name in REQUIRED:
        rules[f"{name}_missing"] = is_object & F.col(name).isNull()
    for name, limit in MAX_LENGTH.items():
        rules[f"{name}_too_long"] = F.char_length(name) > limit
    for name in ("timestamp", "ingestion_timestamp"):
        rules[f"{name}_unreadable"] = F.col(name).isNotNull() & _instant(name).isNull()
    for name in KNOWN_KEYS:
        rules[f"{name}_nested"] = _nested(name)
    return rules


def shape(events: DataFrame, default_source: str) -> DataFrame:
    """Raw columns, delivery order and ``violations`` (comma-separated names of broken rules).

    The payload keeps every key that is not a column, with its JSON type.
    ``source_api`` falls back to ``default_source`` only where the key is
    absent; ``ingestion_timestamp`` has no fallback.
    """
    known = [F.lit(key) for key in KNOWN_KEYS]
    fields = F.try_variant_get("event", "$", "map<string,variant>")
    given = F.variant_get("event", "$.source_api", "variant").isNotNull()
    lifted = (
        events.withColumn(
            "payload", F.to_variant_object(F.map_filter(fields, lambda key, _: ~key.isin(*known)))
        )
        .withColumns({key: F.variant_get("event", f"$.{key}", "string") for key in KNOWN_KEYS})
        .withColumn(
            "source_api", F.when(given, F.col("source_api")).otherwise(F.lit(default_source))
        )
    )
    broken = F.concat_ws(",", *[F.when(rule, F.lit(name)) for name, rule in _rules().items()])
    return lifted.select(
        *ORDER,
        "has_more",
        "event_id",
        "device_id",
        "event_type",
        _instant("timestamp").alias("timestamp"),
        "payload",
        "source_api",
        _instant("ingestion_timestamp").alias("ingestion_timestamp"),
        broken.alias("violations"),
    )


def violations(shaped: DataFrame) -> DataFrame:
    """Broken rules and how many rows break each; empty for a loadable batch."""
    return (
        shaped.filter(F.col("violations") != "")
        .select(F.explode(F.split("violations", ",")).alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
