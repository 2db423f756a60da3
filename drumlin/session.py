"""Session settings the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Day boundaries are UTC, bad numbers raise, and the last of two equal JSON keys wins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name below the cluster's shared ``spark.checkpoint.dir``.

    Only a local session without that setting may fall back to a temporary
    folder; on a cluster the other executors could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="drumlin-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Row groups of tables, scratch and landed files, in bytes. A task reads whole row groups, and parsing what a
#: row holds takes far longer than reading it, so few large ones would leave most cores idle.
ROW_GROUP = 16 << 20
SHREDDING = "spark.sql.variant.writeShredding.enabled"


@contextmanager
def unshredded(spark: SparkSession) -> Iterator[None]:
    """VARIANT columns written meanwhile stay whole."""
    before = spark.conf.get(SHREDDING, None)
    spark.conf.set(SHREDDING, "false")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHREDDING)
        else:
            spark.conf.set(SHREDDING, before)


def write_scratch(df: DataFrame, path: str) -> DataFrame:
    """Write rows to shared scratch and read them back: the work before is not repeated.

    Scratch keeps VARIANT columns whole. Splitting them into typed columns, as
    the tables do, pays off for readers of single keys, of which scratch has none.
    """
    spark = df.sparkSession
    with unshredded(spark):
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this run."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
