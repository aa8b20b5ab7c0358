"""Live status tracking: announced drops of status requests change the store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from orderloom.functions import domain
from orderloom.plans.service import update_statuses
from orderloom.sources.store import OrderStore
from orderloom.streaming.drops import process_drops


def stream_statuses(
    spark: SparkSession,
    markers: str,
    store: OrderStore,
    checkpoint: str,
    schema: StructType | str,
    order: Sequence[str],
    clock: Column | None = None,
    statuses: Sequence[str] = domain.STATUSES,
    drops_per_trigger: int | None = None,
) -> StreamingQuery:
    """Apply the Parquet drops of requests that the store has not seen, in order, then stop.

    Each drop is one bulk update by the batch operator: requests count in ``order``
    inside the drop, start from the stored status, and change nothing where no order is.
    """

    def apply(folder: str, origin: str) -> None:
        requests = spark.read.schema(schema).parquet(folder)
        update_statuses(store, requests, order, clock, statuses, origin)

    return process_drops(spark, markers, store, checkpoint, apply, drops_per_trigger)
