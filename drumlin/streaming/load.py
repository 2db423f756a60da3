"""Load newly landed pages as a stream, with the result of the batch load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from drumlin.operators.upsert import UPDATE
from drumlin.plans.load import load_pages
from drumlin.session import configure
from drumlin.sources import tables
from drumlin.sources.pages import PAGES, from_text

# Note under which the raw table records a stream's last applied micro-batch.
LAST_BATCH = "stream_batch of {}"


def page_file_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None):
    """New page files; see ``sources.pages.read_page_files`` for the layout."""
    schema = "value string, window_start string, window_end string"
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return from_text(reader.text(landing, wholetext=True))


def page_table_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None):
    """New files of a Parquet landing."""
    reader = spark.readStream.schema(PAGES)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(landing)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the stream when it made the checkpoint."""
    return spark.read.schema("id string").json(f"{checkpoint}/metadata").first().id


def load_stream(
    pages: DataFrame,
    root: str,
    checkpoint: str,
    *,
    default_source: str,
    load_ts,
    update: Sequence[str] = UPDATE,
) -> None:
    """Load everything that has landed since the last call, then stop.

    Within a micro-batch events apply in pull order; between micro-batches in
    order of arrival. The number of the last applied micro-batch is published
    together with the rows, so a replay after a crash is skipped. A window may
    be spread over micro-batches, so its completeness is not checked here.
    """
    spark = configure(pages.sparkSession)

    def apply(batch: DataFrame, number: int) -> None:
        # The stream's own id, which a new checkpoint at the same path does not share.
        last_batch = LAST_BATCH.format(stream_id(spark, checkpoint))
        if number <= int(tables.latest(spark, root).notes.get(last_batch, -1)):
            return
        load_pages(
            spark,
            batch,
            root,
            default_source=default_source,
            load_ts=load_ts,
            update=update,
            require_complete=False,
            notes={last_batch: str(number)},
        )

    query = (
        pages.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
