"""Parquet tables that change by publishing a new list of folders.

A table is ``root/data/run=<id>/[<partition>=<value>/]`` plus ``root/versions/<n>``,
one small JSON row naming the folders that make up version n. Writers add
folders and publish them with one new version, so readers and failed runs never
see half a change, unchanged partitions are not copied, and a job may read the
table it is about to replace. One writer per table at a time, as in a daily job.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drumlin.session import ROW_GROUP

VERSION = "version bigint, parts array<struct<value:string,folder:string>>, notes map<string,string>"
# Partition value of a folder without one.
WHOLE = ""


@dataclass(frozen=True)
class Version:
    """Version number, (partition value, folder) pairs and free notes."""

    version: int = 0
    parts: tuple[tuple[str, str], ...] = ()
    notes: dict[str, str] = field(default_factory=dict)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path on the cluster's file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(target):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(target) if s.isDirectory())


def _is_complete(spark: SparkSession, path: str) -> bool:
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def _load_all(spark: SparkSession, paths: list[str]) -> list[Version]:
    """The versions in these folders, oldest first, by one read."""
    rows = spark.read.schema(VERSION).json(paths).collect() if paths else []
    found = [
        Version(row.version, tuple((part.value, part.folder) for part in row.parts), dict(row.notes or {}))
        for row in rows
    ]
    return sorted(found, key=lambda version: version.version)


def versions_since(spark: SparkSession, root: str, after: int) -> list[Version]:
    """Published versions newer than ``after``, oldest first."""
    names = [n for n in _folders(spark, f"{root}/versions") if n.isdigit() and int(n) > after]
    paths = [f"{root}/versions/{name}" for name in names]
    return _load_all(spark, [path for path in paths if _is_complete(spark, path)])


def latest(spark: SparkSession, root: str) -> Version:
    """The newest published version; version 0 with no parts if there is none."""
    for name in reversed(_folders(spark, f"{root}/versions")):
        path = f"{root}/versions/{name}"
        if name.isdigit() and _is_complete(spark, path):
            return _load_all(spark, [path])[0]
    return Version()


def read(
    spark: SparkSession, root: str, schema: T.StructType, parts=None, partition: str | None = None
) -> DataFrame:
    """The table's rows, of the newest version unless ``parts`` says otherwise."""
    parts = latest(spark, root).parts if parts is None else parts
    stored = T.StructType(list(schema))
    if partition and partition not in schema.names:
        stored = stored.add(partition, T.DateType())
    if not parts:
        return spark.createDataFrame([], stored)
    reader = spark.read.schema(stored).option("basePath", f"{root}/data")
    folders = [f"{root}/data/{folder}" for _, folder in parts]
    return reader.parquet(*folders).select(*stored.names)


def write(
    df: DataFrame, root: str, partition: str | None = None, sort: str | None = None
) -> list[tuple[str, str]]:
    """Write a new folder and return its parts, which stay unpublished.

    The rebalance hint lets adaptive execution size the files: it splits a hot
    partition over many tasks and merges small ones.
    """
    spark = df.sparkSession
    run = f"run={uuid.uuid4().hex}"
    path = f"{root}/data/{run}"
    if partition is None:
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
        return [(WHOLE, run)]
    balanced = df.hint("rebalance", partition)
    order = [partition, sort] if sort else [partition]
    ordered = balanced.sortWithinPartitions(*order)
    ordered.write.option("parquet.block.size", ROW_GROUP).partitionBy(partition).parquet(path)
    prefix = f"{partition}="
    names = [name for name in _folders(spark, path) if name.startswith(prefix)]
    return [(name[len(prefix) :], f"{run}/{name}") for name in names]


class Outdated(RuntimeError):
    """Another writer published since this one read the table."""


def publish(
    spark: SparkSession,
    root: str,
    parts,
    notes: dict[str, str] | None = None,
    base: Version | None = None,
) -> Version:
    """Make ``parts`` the table, provided ``base`` (if given) is still its newest version.

    The number follows that of every version folder, also of a writer that died
    halfway. Two writers that choose the same number cannot both succeed.
    """
    if base is not None and latest(spark, root).version != base.version:
        raise Outdated(f"{root} is past version {base.version}")
    taken = [int(name) for name in _folders(spark, f"{root}/versions") if name.isdigit()]
    after = Version(max(taken, default=0) + 1, tuple(sorted(parts)), dict(notes or {}))
    row = spark.createDataFrame([(after.version, list(after.parts), after.notes)], VERSION)
    row.coalesce(1).write.mode("error").json(f"{root}/versions/{after.version:012d}")
    return after


def replace_parts(old, new, values) -> list[tuple[str, str]]:
    """Parts after recomputing the partitions ``values``: all others stay as they are."""
    values = set(values)
    return [part for part in old if part[0] not in values] + list(new)


def remove_unused(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete folders that none of the newest ``keep`` versions names; returns their names.

    For the time between two writers: a running one's folders are not published yet.
    """
    newest = versions_since(spark, root, latest(spark, root).version - keep)
    used = {folder for version in newest for _, folder in version.parts}
    data = f"{root}/data"
    unused = []
    for run in _folders(spark, data):
        parts = [f"{run}/{name}" for name in _folders(spark, f"{data}/{run}")] or [run]
        idle = [name for name in parts if name not in used]
        unused += [run] if idle == parts else idle
    for name in unused:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{data}/{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return unused


def create_if_absent(spark: SparkSession, root: str) -> Version:
    """Publish an empty table unless there is one."""
    found = latest(spark, root)
    return found if found.version else publish(spark, root, [])


def date_values(df: DataFrame, column: str) -> list[str]:
    """Distinct dates of a column as ISO text.

    Callers pass dates bounded on both sides, by the staging window and a run's clock, or by the
    table's own partitions, so the list stays at a few thousand entries.
    """
    days = df.select(F.col(column).cast("string").alias("day")).distinct()
    return sorted(row.day for row in days.collect() if row.day is not None)
