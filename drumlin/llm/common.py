"""Helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager, suppress
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from drumlin.session import scratch

#: Characters of text handled at once in numpy: bounds a worker's memory whatever the batch holds.
CHUNK_CHARS = 4_000_000


T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Rows written to the shared scratch folder and read back: later steps neither repeat the
    work before nor lose it with an executor."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chunks(texts: Sequence[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts with about ``most`` characters (one text at least)."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


_HELD: dict[str, object] = {}


def held(name: str, make: Callable[[], T]) -> T:
    """What a Python worker keeps between partitions: one thing, as the next stage uses the same worker."""
    if name not in _HELD:
        give_back()
        _HELD[name] = make()
    return _HELD[name]


def give_back() -> None:
    """Frees what the worker held for another stage, and returns free memory to the system."""
    _HELD.clear()
    gc.collect()
    trim()


def trim() -> None:
    """Returns free memory to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[T]], Iterator[T]]) -> Callable[[Iterator[T]], Iterator[T]]:
    """The same work on a partition, by a worker that keeps nothing of another stage, nor memory after it: an executor's
    workers take turns, so one that waits holds what it took at its most."""

    def tidied(batches: Iterator[T]) -> Iterator[T]:
        if _HELD:
            give_back()
        yield from run(batches)
        trim()

    return tidied


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded(spark: SparkSession, rows: int) -> None:
    """From now on the session hands Python batches of so many rows at most: an executor and its workers hold several."""
    if not 0 < int(spark.conf.get(BATCH_ROWS)) <= rows:
        spark.conf.set(BATCH_ROWS, str(rows))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs meanwhile hands Python batches of so many rows at most."""
    before = spark.conf.get(BATCH_ROWS)
    bounded(spark, rows)
    try:
        yield
    finally:
        spark.conf.set(BATCH_ROWS, before)


def strings(values: Iterable[object]) -> list[str]:
    """Texts of a column; null becomes the empty text."""
    return [x if isinstance(x, str) else "" for x in values]


def unused(name: str, columns: Iterable[str]) -> str:
    """The name, or one like it that none of the columns has."""
    while name in columns:
        name += "_"
    return name
