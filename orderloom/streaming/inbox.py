"""Continuous intake: every announced drop of CSV files becomes one import."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions import domain
from orderloom.plans.loading import import_orders
from orderloom.sources.csv import list_files, load_orders
from orderloom.sources.store import OrderStore
from orderloom.streaming.drops import process_drops


def stream_intake(
    spark: SparkSession,
    markers: str,
    store: OrderStore,
    checkpoint: str,
    drops_per_trigger: int | None = None,
    multi_line: bool = False,
    pattern: str = "*.csv",
) -> StreamingQuery:
    """Import the announced drops that have not been imported, in order, then stop.

    Rows are read by the same CSV source as in batch, so columns bind by name and file
    order is kept; a repeated code is found anywhere in its drop. A drop without orders
    is passed over.
    """

    def load(folder: str, origin: str) -> None:
        sources = list_files(spark, folder, pattern).select("source")
        raw = load_orders(spark, folder, multi_line)
        result = import_orders(store, raw, sources, confirmed=True, origin=origin)
        if not result.success and result.message != domain.IMPORT_EMPTY:
            raise RuntimeError(result.message)

    return process_drops(spark, markers, store, checkpoint, load, drops_per_trigger)
