"""Which partitions of the raw table may hold a key.

Event ids are random, so a range of ids or a file's statistics rule out nothing. The index has a row
for each key: its hash and the ``created_date`` it was first loaded on, which never changes. It is
dealt into buckets by hash and sorted by it, so a batch reads the buckets its keys fall into, by two
narrow columns, and then only the raw partitions that hold one of them. Two keys of one hash cost a
partition read in vain and nothing else: the load compares the ids themselves.

The index is published before the raw table. It may therefore name rows of a load that failed, never
lack one of a load that did not. A raw table it does not cover is indexed anew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.contract import RAW
from drumlin.sources import tables

BUCKETS = 16
#: Folders of a bucket from which they are rewritten as one.
MOST_PARTS = 16
PARTITION = "bucket"
COVERS = "covers"
INDEX = T.StructType(
    [
        T.StructField("key_hash", T.LongType()),
        T.StructField("created_date", T.DateType()),
        T.StructField(PARTITION, T.IntegerType()),
    ]
)


def root_of(raw_root: str) -> str:
    return f"{raw_root}/keys"


def hashed(key: str = "event_id") -> Column:
    return F.xxhash64(key)


def bucket_of(key_hash: str = "key_hash") -> Column:
    # The high bits: neighbours in a bucket's order are then neighbours in the whole order.
    return (F.shiftrightunsigned(key_hash, 56) % F.lit(BUCKETS)).cast("int")


def _entries(rows: DataFrame) -> DataFrame:
    """Index rows of (event_id, created_date)."""
    narrow = rows.select(hashed().alias("key_hash"), F.col("created_date"))
    return narrow.withColumn(PARTITION, bucket_of())


def _current(spark: SparkSession, raw_root: str, raw: tables.Version) -> tables.Version:
    """The index of the raw table's version; built from the table if it covers less."""
    root = root_of(raw_root)
    index = tables.latest(spark, root)
    if int(index.notes.get(COVERS, -1)) >= raw.version:
        return index
    rows = tables.read(spark, raw_root, RAW, raw.parts, "created_date").select("event_id", "created_date")
    parts = tables.write(_entries(rows), root, PARTITION, "key_hash")
    return tables.publish(spark, root, parts, {COVERS: str(raw.version)})


def dates_of(spark: SparkSession, raw_root: str, raw: tables.Version, batch: DataFrame) -> list[str]:
    """The raw table's partitions that may hold a key of the batch.

    At most ``BUCKETS`` numbers and one date a partition reach the driver.
    """
    if not raw.parts:
        return []
    return tables.date_values(_found(spark, raw_root, raw, batch), "created_date")


def _found(spark: SparkSession, raw_root: str, raw: tables.Version, batch: DataFrame) -> DataFrame:
    """The index rows of the batch's keys."""
    index = _current(spark, raw_root, raw)
    keys = _entries(batch.select("event_id", F.lit(None).cast("date").alias("created_date"))).select("key_hash", PARTITION).distinct()
    wanted = {str(row[0]) for row in keys.select(PARTITION).distinct().collect()}
    parts = [part for part in index.parts if part[0] in wanted]
    rows = tables.read(spark, root_of(raw_root), INDEX, parts, PARTITION)
    return rows.join(keys.select("key_hash"), "key_hash", "left_semi")


def extend(spark: SparkSession, raw_root: str, raw: tables.Version, added: DataFrame) -> None:
    """Publish the index with the rows (event_id, created_date) that the next version of ``raw`` adds."""
    root = root_of(raw_root)
    index = _current(spark, raw_root, raw)
    parts = [*index.parts, *tables.write(_entries(added), root, PARTITION, "key_hash")]
    count: dict[str, int] = {}
    for bucket, _ in parts:
        count[bucket] = count.get(bucket, 0) + 1
    many = {bucket for bucket, n in count.items() if n >= MOST_PARTS}
    if many:
        together = tables.read(spark, root, INDEX, [part for part in parts if part[0] in many], PARTITION)
        parts = tables.replace_parts(parts, tables.write(together, root, PARTITION, "key_hash"), many)
    tables.publish(spark, root, parts, {COVERS: str(raw.version + 1)}, base=index)
