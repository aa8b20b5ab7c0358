"""Drops: folders of files that are processed whole, one after another.

A drop is announced by a marker once all its files are in place. Streams read
markers, never data files, so a drop is never cut by a limit on how much one
micro-batch takes: limits only decide how many whole drops a micro-batch holds.
Drops are processed in the order of their markers (time, then name), whatever
the micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.sources.store import OrderStore

_MARKER = "name string, folder string"


def announce(spark: SparkSession, markers: str, name: str, folder: str) -> None:
    """Add the marker of one drop; its files must not change afterwards."""
    rows = spark.createDataFrame([(name, folder)], _MARKER)
    rows.coalesce(1).write.mode("append").json(markers)


def process_drops(
    spark: SparkSession,
    markers: str,
    store: OrderStore,
    checkpoint: str,
    process: Callable[[str, str], None],
    drops_per_trigger: int | None = None,
) -> StreamingQuery:
    """Call ``process(folder, origin)`` for every announced drop the store has not seen, then stop.

    ``process`` publishes its batch under ``origin``. A drop that fails raises, so the next
    run retries it; one that was published before the checkpoint noticed is skipped.
    """
    reader = spark.readStream.schema(_MARKER)
    if drops_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", drops_per_trigger)
    announced = reader.json(markers).select(
        "name", "folder", F.col("_metadata.file_modification_time").alias("announced")
    )

    def handle(batch: DataFrame, _: int) -> None:
        # One row per drop, however many files the drops have.
        for drop in batch.orderBy("announced", "name").toLocalIterator():
            origin = f"drop:{drop.name}"
            if not store.has_origin(origin):
                process(drop.folder, origin)

    return (
        announced.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
