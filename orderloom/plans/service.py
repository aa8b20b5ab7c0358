"""What a user does with a store: create, find, update, delete and export orders in bulk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.operators import browse, customers
from orderloom.operators.storage import materialize
from orderloom.plans import history, intake, lifecycle
from orderloom.plans.loading import Preview, load_batch
from orderloom.plans.loading import preview as preview_import
from orderloom.sources import csv
from orderloom.sources.store import OrderStore


def all_orders(store: OrderStore) -> DataFrame:
    """Every order with its customer name, by id."""
    return browse.by_id(browse.order_view(store.orders(), store.customers()))


def browse_orders(
    store: OrderStore,
    status: str | None = "",
    customer_name: str = "",
    sort_by: str = "order_code",
    direction: str = "ascending",
) -> DataFrame:
    view = browse.order_view(store.orders(), store.customers())
    return browse.browse(view, status, customer_name, sort_by, direction, normalized=True)


def search_order(store: OrderStore, code: str) -> DataFrame:
    return browse.order_view(store.orders((code or "").strip().upper()), store.customers())


def list_customers(store: OrderStore) -> DataFrame:
    return customers.listing(store.customers())


def search_customers(store: OrderStore, wanted: str) -> DataFrame:
    return customers.search(store.customers(), wanted)


def statistics(store: OrderStore) -> DataFrame:
    """Orders per status and in all, from the counts kept with each batch."""
    return browse.with_total(store.status_counts())


def export_orders(store: OrderStore, path: str) -> int:
    return csv.export_orders(browse.order_view(store.orders(), store.customers()), path)


def preview(store: OrderStore, feed: DataFrame) -> Preview:
    """What importing a feed would do: counts, reasons, orders to import and to skip."""
    return preview_import(store, feed)


def create_orders(
    store: OrderStore, candidates: DataFrame, statuses: Sequence[str] = domain.STATUSES
) -> DataFrame:
    """Store each valid candidate, one after another in ``pos`` order; returns all with errors."""
    registry = store.orders().select("order_code")
    checked = intake.validate_creations(candidates, registry, statuses)
    validated = materialize(customers.with_keys(checked), "candidates")
    batch_id = store.next_batch()
    load_batch(store, intake.accepted(validated), batch_id)
    store.publish(batch_id, ["customers", "orders"])
    return validated.drop("customer_key")


def update_statuses(
    store: OrderStore,
    requests: DataFrame,
    order: Sequence[str],
    clock: Column | None = None,
    statuses: Sequence[str] = domain.STATUSES,
    origin: str | None = None,
) -> DataFrame:
    """Apply update requests; orders and history change together, as one published batch.

    ``clock`` says when a change happened, by default now; ``origin`` where the
    requests came from. Returns every request with its outcome and message.
    """
    stored = store.orders()
    outcomes = lifecycle.update_statuses(requests, stored, order, statuses).withColumn(
        "_at", F.current_timestamp() if clock is None else clock
    )
    written = publish_updates(store, outcomes, order, origin)
    return written.drop("_at").withColumn("message", lifecycle.update_message())


def publish_updates(
    store: OrderStore, outcomes: DataFrame, order: Sequence[str], origin: str | None = None
) -> DataFrame:
    """Store the changes among outcomes (with the time ``_at``) as one batch; returns the written outcomes."""
    outcomes = materialize(outcomes, "updates")
    last = (
        outcomes.where(F.col("outcome") == lifecycle.UPDATED)
        .groupBy("order_code")
        .agg(F.max_by("status", F.struct(*order)).alias("status"))
    )
    batch_id = store.next_batch()
    changed = store.orders().select("id", "order_code").join(last, "order_code").select("id", "order_code", "status")
    store.write("updates", changed, batch_id)
    audit = lifecycle.audit_rows(outcomes, order, F.col("_at"), store.last_id("history"))
    store.write("history", audit, batch_id)
    store.publish(batch_id, ["updates", "history"], origin=origin)
    return outcomes


def delete_orders(store: OrderStore, requests: DataFrame) -> DataFrame:
    """Delete the requested orders (``pos``, ``order_code``); their history stays."""
    stored = store.orders()
    outcomes = materialize(lifecycle.delete_outcomes(requests, stored), "deletes")
    gone = outcomes.where(F.col("outcome") == lifecycle.DELETED).select("order_code")
    batch_id = store.next_batch()
    removed = stored.join(gone, "order_code", "left_semi").select("id", "order_code")
    store.write("deletions", removed, batch_id)
    store.publish(batch_id, ["deletions"])
    return outcomes


def status_history(store: OrderStore, code: str) -> DataFrame:
    """The recorded changes of one order, numbered, oldest first."""
    return history.with_positions(history.for_code(store.history(), code)).orderBy("id")


def look_up_history(store: OrderStore, codes: DataFrame) -> DataFrame:
    """Current status, number of changes and message for every requested code."""
    return history.look_up(store.history(), store.orders(), codes)
