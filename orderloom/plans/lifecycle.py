"""Order lifecycle in bulk: status updates, deletes, and replay of a command log.

Requests and commands carry ``order_code`` plus order columns (say ``ts,
event_id``) that give arrival order and are unique per row. Results are
derived tables; history is append-only and outlives its orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import domain, text
from orderloom.operators import codes
from orderloom.operators.ids import dense_ids
from orderloom.operators.storage import materialize
from orderloom.operators.timeline import Timeline, count_rows

# What became of one request.
CREATED, UPDATED, UNCHANGED = "created", "updated", "unchanged"
DELETED, NOT_FOUND, REJECTED = "deleted", "not_found", "rejected"


def normalize_requests(requests: DataFrame) -> DataFrame:
    return requests.withColumns(
        {"order_code": text.order_code(F.col("order_code")), "status": text.status(F.col("status"))}
    )


def _initial(stored: DataFrame) -> DataFrame:
    return stored.select("order_code", F.col("status").alias("_stored"))


def _with_stored(asked: DataFrame, stored: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Add the stored status. The store is cut to the asked codes first, by a broadcast if they are few.

    ``counts`` may name these codes, each once.
    """
    codes_asked = (asked if counts is None else counts).select("order_code")
    wanted = _initial(stored).join(codes_asked, "order_code", "left_semi")
    return asked.join(wanted, "order_code", "left")


def update_statuses(
    requests: DataFrame,
    stored: DataFrame,
    order: Sequence[str],
    statuses: Sequence[str] = domain.STATUSES,
) -> DataFrame:
    """Each update request with ``old_status`` and ``outcome``.

    Only requests for a known status on a stored order count; their status is
    the next request's old status. Repeating the current status changes nothing.
    """
    status = F.col("status")
    valid = status.isin(*statuses)
    asked = normalize_requests(requests)
    # Written, as both the sizes of the keys and the cut of the store come from it.
    counts = materialize(count_rows(asked, "order_code"), "asked")
    timed = Timeline(_with_stored(asked, stored, counts), "order_code", order, counts).last_before(
        F.when(valid, status), "_previous"
    )
    old = F.coalesce("_previous", "_stored")
    outcome = (
        F.when(F.col("_stored").isNull(), NOT_FOUND)
        .when(~valid, REJECTED)
        .when(old == status, UNCHANGED)
        .otherwise(UPDATED)
    )
    return (
        timed.rows()
        .withColumns(
            {
                "old_status": F.when(F.col("_stored").isNotNull(), old),
                "outcome": outcome,
            }
        )
        .drop("_previous", "_stored")
    )


def update_message() -> Column:
    """What an update request is told."""
    code = F.col("order_code")
    return (
        F.when(F.col("outcome") == NOT_FOUND, F.format_string(domain.NO_ORDER, code))
        .when(F.col("outcome") == REJECTED, F.format_string(domain.NOT_UPDATED, code))
        .otherwise(F.format_string(domain.UPDATED, code))
    )


def current_statuses(outcomes: DataFrame, stored: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored orders with the status after all updates."""
    last = (
        outcomes.where(F.col("outcome") == UPDATED)
        .groupBy("order_code")
        .agg(F.max_by("status", F.struct(*order)).alias("_last"))
    )
    return (
        stored.join(last, "order_code", "left")
        .withColumn("status", F.coalesce("_last", "status"))
        .drop("_last")
    )


def transitions(outcomes: DataFrame, order: Sequence[str]) -> DataFrame:
    """The real status changes among the outcomes."""
    return outcomes.where(F.col("outcome") == UPDATED).select(
        *order, "order_code", "old_status", F.col("status").alias("new_status")
    )


def moment(clock: Column) -> Column:
    """A time as text to the second, read off without any time zone arithmetic."""
    return F.substring(clock.cast("string"), 1, 19)


def history_rows(changes: DataFrame, order: Sequence[str], after: int = 0, more: Sequence[str] = ()) -> DataFrame:
    """Real status changes with their ``changed_at`` as history rows, ids in arrival order; ``more`` columns follow."""
    return dense_ids(changes, order, "id", after).select(
        "id", "order_code", "old_status", "new_status", "changed_at", *more
    )


def audit_rows(
    outcomes: DataFrame, order: Sequence[str], clock: Column, after: int = 0
) -> DataFrame:
    """The real status changes among the outcomes as history rows; ``clock`` is when each happened."""
    changes = transitions(outcomes.withColumn("changed_at", moment(clock)), [*order, "changed_at"])
    return history_rows(changes, order, after)


def delete_outcomes(requests: DataFrame, orders: DataFrame) -> DataFrame:
    """Each delete request with its outcome; a second request for a code finds nothing."""
    wanted = requests.withColumn("order_code", text.order_code(F.col("order_code")))
    flagged = codes.flag_stored_firsts(wanted, orders).withColumn(
        "outcome", F.when(F.col("stored"), DELETED).otherwise(NOT_FOUND)
    )
    message = F.when(F.col("stored"), F.format_string(domain.DELETED, F.col("order_code")))
    missing = F.format_string(domain.NO_ORDER, F.col("order_code"))
    return flagged.withColumn("message", F.coalesce(message, missing)).drop("stored")


def delete_orders(orders: DataFrame, requests: DataFrame) -> DataFrame:
    """Orders that remain; history is a table of its own and stays."""
    wanted = requests.select(text.order_code(F.col("order_code")).alias("order_code"))
    return codes.not_stored(orders, wanted)


def replay(
    commands: DataFrame,
    order: Sequence[str],
    stored: DataFrame | None = None,
    statuses: Sequence[str] = domain.STATUSES,
) -> DataFrame:
    """A mixed create / update / delete log with ``old_status`` and ``outcome`` per command.

    Whether an order exists follows from the last create or delete before the
    command; its status from the last command that set one. Both are "last
    value before" columns over the same partitioning, so they share one shuffle.
    """
    op, status = F.col("op"), F.col("status")
    valid = status.isin(*statuses)
    log = asked = normalize_requests(commands)
    if stored is None:
        log = log.withColumn("_stored", F.lit(None).cast("string"))
    else:
        log = _with_stored(log, stored)
    exists_after = F.when((op == "create") & valid, True).when(op == "delete", False)
    log = log.withColumn("_exists_after", exists_after)
    alive = (
        Timeline(log, "order_code", order, count_rows(asked, "order_code"))
        .last_before(F.col("_exists_after"), "_exists_before")
        .derive({"_alive": F.coalesce("_exists_before", F.col("_stored").isNotNull())})
    )
    sets = ((op == "create") & ~F.col("_alive") & valid) | (
        (op == "update") & F.col("_alive") & valid
    )
    timed = alive.derive({"_set": F.when(sets, status)}).last_before(F.col("_set"), "_previous")
    old = F.coalesce("_previous", "_stored")
    outcome = (
        F.when((op == "create") & (F.col("_alive") | ~valid), REJECTED)
        .when(op == "create", CREATED)
        .when(~F.col("_alive"), NOT_FOUND)
        .when(op == "delete", DELETED)
        .when(~valid, REJECTED)
        .when(old == status, UNCHANGED)
        .otherwise(UPDATED)
    )
    return (
        timed.rows()
        .withColumns({"old_status": F.when(F.col("_alive"), old), "outcome": outcome})
        .drop("_stored", "_exists_after", "_exists_before", "_alive", "_set", "_previous")
    )


def live_orders(
    replayed: DataFrame, order: Sequence[str], stored: DataFrame | None = None
) -> DataFrame:
    """Orders that exist after the log, with their status."""
    effective = replayed.where(F.col("outcome").isin(CREATED, UPDATED, DELETED))
    ends = effective.groupBy("order_code").agg(
        F.max_by(F.struct("op", "status"), F.struct(*order)).alias("_end")
    )
    live = F.col("_end.op") != "delete"
    if stored is None:
        return ends.where(live).select("order_code", F.col("_end.status").alias("status"))
    return (
        ends.join(_initial(stored), "order_code", "full_outer")
        .where(F.col("_end").isNull() | live)
        .select("order_code", F.coalesce("_end.status", "_stored").alias("status"))
    )
