"""Insert-or-update by key, with the reference's three conflict policies.

A batch may hold a key many times and is meant to apply row by row. The
outcome needs only two of a key's rows: the first gives the inserted values,
the last gives the updated ones. ``collapse`` finds both with one aggregation
that combines before the shuffle, so a key with a third of all rows costs one
row per task. After it each side has one row per key and the join cannot skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns a conflicting row overwrites, per policy.
UPDATE = ("device_id", "event_type", "timestamp", "payload")
NARROW = ("device_id", "timestamp", "payload")
IGNORE = ()


def collapse(
    batch: DataFrame, key: str, columns: Sequence[str], update: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key: ``updates`` (last row), ``inserts`` (first row) and the row count."""
    seq = F.struct(*order)
    # A struct keeps NULLs: max_by on a bare column would be fine too, but loses the row's unity.
    aggregates = [
        F.count(F.lit(1)).alias("rows"),
        F.min_by(F.struct(*[c for c in columns if c not in update]), seq).alias("inserts"),
    ]
    if update:
        aggregates.append(F.max_by(F.struct(*update), seq).alias("updates"))
    return batch.groupBy(key).agg(*aggregates)


def new_value(column: str, update: Sequence[str], side: str = "") -> Column:
    return F.col(f"{side}updates.{column}" if column in update else f"{side}inserts.{column}")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    *,
    key: str,
    update: Sequence[str],
    order: Sequence[str],
    defaults: dict[str, Column] | None = None,
) -> DataFrame:
    """The target after the batch.

    Columns in ``update`` take the batch's value; all others keep the target's
    and come from the batch only for new keys. ``defaults`` fills columns the
    batch does not carry, also for new keys only.
    """
    defaults = defaults or {}
    columns = [c for c in target.columns if c != key and c not in defaults]
    changes = collapse(batch, key, columns, update, order).withColumn("hit", F.lit(True))
    old = target.withColumn("kept", F.lit(True))
    joined = old.alias("t").join(changes.alias("b"), key, "full_outer")
    hit, kept = F.coalesce("hit", F.lit(False)), F.coalesce("kept", F.lit(False))

    def merged(name: str) -> Column:
        if name == key:
            return F.col(key)
        if name in update:
            return F.when(hit, new_value(name, update)).otherwise(F.col(f"t.{name}")).alias(name)
        fresh = defaults[name] if name in defaults else new_value(name, update)
        return F.when(kept, F.col(f"t.{name}")).otherwise(fresh).alias(name)

    return joined.select(*[merged(name) for name in target.columns])
