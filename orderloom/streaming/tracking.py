"""Live status tracking: commands and status requests against keyed state.

The state of a code is whether its order exists and its last accepted status. It lives in the
state store (RocksDB) under the query's checkpoint, so a query that stops goes on where it was.
It begins with the code's first request, from the stored order that is joined to the request: orders
nobody asks for make no state, so the cost of the state follows the requests and not the store.
Requests count in arrival order: micro-batch after micro-batch, and by ``order`` inside one, where
rows come shuffled. So the result is that of the batch operators as long as micro-batches follow
each other in that order, whatever their size.

A code's rows of one micro-batch are taken in one after another by one task. How many that can be is
bounded by what the source admits to a micro-batch (``maxFilesPerTrigger``, ``maxBytesPerTrigger``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from orderloom.functions import domain
from orderloom.plans import lifecycle, service
from orderloom.sources.store import OrderStore

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_RESULT = ("order_code", "op", "status", "old_status", "outcome")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB, on disk and in checkpoints."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def step(alive: bool, current: str | None, op: str, status: str | None, valid: bool) -> tuple[str, bool, str | None]:
    """What becomes of one command, and the order's state after it."""
    if op == "create":
        return (lifecycle.REJECTED, alive, current) if alive or not valid else (lifecycle.CREATED, True, status)
    if not alive:
        return lifecycle.NOT_FOUND, alive, current
    if op == "delete":
        return lifecycle.DELETED, False, current
    if not valid:
        return lifecycle.REJECTED, alive, current
    return (lifecycle.UNCHANGED if status == current else lifecycle.UPDATED), alive, status


class _Tracker(StatefulProcessor):
    def __init__(self, order: Sequence[str]):
        self.order = list(order)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("order", "alive boolean, status string")

    def _place(self, row: Row) -> list[tuple]:
        return [(part is not None, part) for part in row[: len(self.order)]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # By place: a lookup of a field by its name takes longer than the step.
        result, width, code = Row(*self.order, *_RESULT), len(self.order), key[0]
        asked = sorted(rows, key=self._place)
        before = self.state.get()
        alive, current = tuple(before) if before else asked[0][width + 4 :]
        before = tuple(before) if before else (False, None)
        for row in asked:
            old = current if alive else None
            op, status, valid = row[width + 1 : width + 4]
            outcome, alive, current = step(alive, current, op, status, valid)
            yield result(*row[:width], code, op, status, old, outcome)
        if (alive, current) != before:
            self.state.update((alive, current))


def stream_commands(
    commands: DataFrame,
    order: Sequence[str],
    stored: DataFrame | None = None,
    statuses: Sequence[str] = domain.STATUSES,
) -> DataFrame:
    """The streamed commands (``order_code, op, status`` and ``order``) with ``old_status`` and ``outcome``.

    ``stored`` (``order_code, status``) is what exists when a code is first asked for;
    from then on its state counts, also in a restarted query. The result is that of ``lifecycle.replay``.
    """
    log = lifecycle.normalize_requests(commands)
    valid = F.coalesce(F.col("status").isin(*statuses), F.lit(False))
    log = log.select(*order, "order_code", "op", "status", valid.alias("valid"))
    text = [StructField(name, StringType()) for name in _RESULT]
    output = StructType([*[log.schema[name] for name in order], *text])
    if stored is None:
        log = log.withColumns({"stored": F.lit(False), "stored_status": F.lit(None).cast("string")})
    else:
        # Merged, as the state deals by code as well and a store may be too large to broadcast.
        known = stored.select("order_code", F.lit(True).alias("_known"), F.col("status").alias("stored_status"))
        log = log.join(known.dropDuplicates(["order_code"]).hint("merge"), "order_code", "left")
        log = log.withColumn("stored", F.coalesce("_known", F.lit(False)))
    log = log.select(*order, "order_code", "op", "status", "valid", "stored", "stored_status")
    return log.groupBy("order_code").transformWithState(_Tracker(order), output, "Append", "None")


def stream_updates(
    requests: DataFrame, order: Sequence[str], stored: DataFrame, statuses: Sequence[str] = domain.STATUSES
) -> DataFrame:
    """Streamed status requests with ``old_status`` and ``outcome``, as ``lifecycle.update_statuses`` gives."""
    return stream_commands(requests.withColumn("op", F.lit("update")), order, stored, statuses).drop("op")


def stream_transitions(
    requests: DataFrame, order: Sequence[str], stored: DataFrame, statuses: Sequence[str] = domain.STATUSES
) -> DataFrame:
    """The real status changes among streamed requests."""
    return lifecycle.transitions(stream_updates(requests, order, stored, statuses), order)


def run(rows: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Give every micro-batch of stateful rows to ``handle``; by now available input, then stop."""
    with rocksdb(rows.sparkSession):
        writer = rows.writeStream.outputMode("append").foreachBatch(handle)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def collect_into(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Write each micro-batch to a folder of its own, which a repeated one overwrites."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return run(rows, checkpoint, write)


def track_statuses(
    requests: DataFrame,
    store: OrderStore,
    checkpoint: str,
    order: Sequence[str],
    clock: Column | None = None,
    statuses: Sequence[str] = domain.STATUSES,
) -> StreamingQuery:
    """Apply streamed status requests to the store, one published batch for each micro-batch with a change.

    ``clock`` is when a change happened, by the columns of ``order``. Orders are known from the store
    as it is when the query first starts. A micro-batch published already is not published again.
    """
    rows = stream_updates(requests, order, store.orders(), statuses)

    def publish(batch: DataFrame, number: int) -> None:
        origin = f"track:{checkpoint}:{number}"
        if not store.has_origin(origin):
            at = F.current_timestamp() if clock is None else clock
            service.publish_updates(store, batch.withColumn("_at", at), order, origin)

    return run(rows, checkpoint, publish)
