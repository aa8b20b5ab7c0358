"""Continuous intake of order files: a stream of their lines, one published batch per micro-batch.

Every file is a drop. All drops of a micro-batch are read, bound to columns by their headers and
validated in one plan, with the result of importing them one after another by modification time
and name. The batch is published under the micro-batch's number together with the versions of its
files, so a micro-batch that runs again changes nothing, and neither does a new checkpoint over
files consumed already.

Spark's file source knows files by path alone and never reads a path twice. ``sweep`` looks after
files written anew under their name: the store knows its input by version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions import domain
from orderloom.operators.storage import materialize
from orderloom.plans import loading
from orderloom.sources import csv, records
from orderloom.sources.store import OrderStore


def _import(store: OrderStore, lines: DataFrame, files: DataFrame, origin: str) -> None:
    """Load the lines of ``files`` (written versions) as one batch; without orders only the files are recorded."""
    in_turn = F.row_number().over(Window.orderBy("modified", "source"))
    drops = materialize(files.select(F.col("source").alias("file"), in_turn.alias("drop")), "drops")
    split = records.split_records(lines.join(F.broadcast(drops.select("file")), "file", "left_semi"))
    bound = materialize(records.bind_fields(split, domain.ORDER_FIELDS), "drop")
    raw = records.number_rows(bound, drops).select("pos", "drop", *domain.ORDER_FIELDS)
    shown = loading.preview(store, raw, by_drop=True)
    if shown.total_orders == 0:
        store.publish(store.next_batch(), [], files, origin)
        return
    result = loading.import_orders(store, shown, files, confirmed=True, origin=origin)
    if not result.success:
        raise RuntimeError(result.message)


def stream_orders(
    spark: SparkSession,
    inbox: str,
    store: OrderStore,
    checkpoint: str,
    files_per_trigger: int | None = None,
    pattern: str = "*.csv",
    archive: str | None = None,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Import the order files that appear below ``inbox``; by default those there now, then stop.

    Files must appear whole (written elsewhere and renamed). ``archive`` is a folder outside the
    inbox that finished files are moved to; what is consumed is recorded by the store, not by where
    a file lies.
    """
    reader = spark.readStream.option("lineSep", "\n").option("pathGlobFilter", pattern)
    reader = reader.option("recursiveFileLookup", True)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def handle(batch: DataFrame, number: int) -> None:
        origin = f"orders:{checkpoint}:{number}"
        if store.has_origin(origin):
            return
        seen = batch.select(F.col("file").alias("source"), "length", "modified").distinct()
        files = materialize(store.pending(seen), "versions")
        if not files.isEmpty():
            _import(store, batch, files, origin)

    lines = records.with_origin(reader.text(inbox))
    writer = lines.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def sweep(spark: SparkSession, store: OrderStore, listed: DataFrame) -> int:
    """Import the files of a written listing that are still pending, as one batch; returns how many.

    For a listing taken before a stream over the same files ran to its end, these are the files it
    passed over: written anew under a path it had read, or once seen empty.
    """
    missed = store.pending(listed).select("source").toLocalIterator()
    paths = [csv.as_path(row.source) for row in missed]
    if paths:
        lines = records.with_origin(spark.read.option("lineSep", "\n").text(paths))
        versions = lines.select(F.col("file").alias("source"), "length", "modified").distinct()
        _import(store, lines, materialize(versions, "versions"), f"sweep:{store.next_batch()}")
    return len(paths)


def run_inbox(
    spark: SparkSession,
    inbox: str,
    store: OrderStore,
    checkpoint: str,
    files_per_trigger: int | None = None,
    pattern: str = "*.csv",
    archive: str | None = None,
) -> None:
    """One pass over the inbox: new files by the stream, then those it passed over."""
    listed = materialize(csv.list_files(spark, inbox, pattern), "listing")
    stream_orders(spark, inbox, store, checkpoint, files_per_trigger, pattern, archive).awaitTermination()
    sweep(spark, store, listed)
