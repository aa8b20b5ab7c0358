"""Loading accepted orders: functional appends and the published import."""

from __future__ import annotations

import logging
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import domain, text
from orderloom.operators import codes, customers
from orderloom.operators.ids import dense_ids
from orderloom.operators.storage import materialize
from orderloom.plans import intake
from orderloom.sources import reports
from orderloom.sources.store import OrderStore

log = logging.getLogger(__name__)

ORDER_COLUMNS = ("id", "order_code", "customer_id", "quantity", "status")


def number_orders(accepted: DataFrame, dimension: DataFrame, after: int = 0) -> DataFrame:
    """Accepted rows as stored orders: customer resolved, ids in feed order after ``after``."""
    linked = customers.resolve(accepted, dimension)
    return dense_ids(linked, ["pos"], "id", after).select(*ORDER_COLUMNS)


def append_orders(
    accepted: DataFrame, orders: DataFrame, dimension: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Stored orders and customers after loading ``accepted``."""
    extended = customers.upsert(accepted, dimension)
    added = number_orders(accepted, extended, customers.highest_id(orders))
    return orders.select(*ORDER_COLUMNS).unionByName(added), extended


def insert_or_ignore(
    rows: DataFrame, orders: DataFrame, dimension: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Orders to add when repeats inside the rows and stored codes are ignored, and the dimension.

    Rows are normalized but not validated, except that every quantity must be an
    integer: one that is not raises before anything is stored. Every row's
    customer is created, also when its order is ignored.
    """
    normalized = _castable(rows)
    extended = customers.upsert(normalized, dimension)
    fresh = codes.not_stored(codes.first_rows(normalized), orders)
    return number_orders(fresh, extended, customers.highest_id(orders)), extended


def _castable(rows: DataFrame) -> DataFrame:
    """Normalized rows, written, with integer quantities; raises if there is another one."""
    typed = customers.with_keys(intake.normalize_orders(rows)).withColumn(
        "quantity", text.to_quantity(F.col("quantity"))
    )
    normalized = materialize(typed, "seed")
    broken = normalized.where(F.col("quantity").isNull()).count()
    if broken:
        raise ValueError(f"{broken} rows have a quantity that is no integer; nothing was stored")
    return normalized


def store_or_ignore(store: OrderStore, rows: DataFrame) -> int:
    """Insert or ignore ``rows`` into the store as one published batch; returns how many orders it added.

    Customers of ignored orders are stored as well. Without a new order or customer nothing is published.
    """
    normalized = _castable(rows)
    dimension = store.customers()
    fresh = codes.not_stored(codes.first_rows(normalized), store.orders())
    batch_id = store.next_batch()
    store.write("customers", customers.additions(normalized, dimension), batch_id)
    new = store.written("customers", batch_id)
    linked = number_orders(fresh, dimension.unionByName(new), store.last_id("orders"))
    store.write("orders", linked, batch_id)
    added = store.written("orders", batch_id).count()
    if added or not new.isEmpty():
        store.publish(batch_id, ["customers", "orders"])
    return added


@dataclass(frozen=True)
class ImportResult:
    """What an import did; the row sets stay distributed."""

    success: bool
    cancelled: bool
    saved: int
    skipped: int
    reported: int
    input_consumed: bool
    message: str
    skipped_orders: DataFrame | None = None
    saved_orders: DataFrame | None = None


@dataclass(frozen=True)
class Preview:
    """What an import would do, all of it read from one written table."""

    validated: DataFrame
    total_orders: int
    valid_orders: int
    invalid_orders: int
    requires_confirmation: bool
    seen: tuple[int, ...]
    # Several drops, each validated as if those before it had been loaded.
    by_drop: bool = False

    @property
    def reasons(self) -> DataFrame:
        return intake.reason_summary(self.validated)

    @property
    def orders_to_import(self) -> DataFrame:
        return intake.accepted(self.validated).drop("customer_key")

    @property
    def orders_to_skip(self) -> DataFrame:
        return intake.rejected(self.validated).drop("customer_key")


def preview(store: OrderStore, raw: DataFrame, by_drop: bool = False) -> Preview:
    """Validate a feed against the store once and write the outcome; the store is not changed.

    ``by_drop`` says that the feed is several drops (column ``drop``), one after another.
    """
    seen = tuple(store.published())
    validate = intake.validate_drops if by_drop else intake.validate
    checked = validate(raw, store.orders().select("order_code"))
    validated = materialize(customers.with_keys(checked), "validated")
    counts = intake.preview_counts(validated).first()
    return Preview(validated, *counts, seen, by_drop)


def refresh(store: OrderStore, shown: Preview) -> Preview:
    """The preview as it would be now. Only orders whose code was loaded or deleted since it was
    made are checked again, against what the batches since then say of their codes."""
    changes = materialize(store.code_changes(max(shown.seen, default=-1)), "changes")
    seen = tuple(store.published())
    if changes.isEmpty():
        return replace(shown, seen=seen)
    changed = changes.select("order_code")
    touched = shown.validated.join(changed, "order_code", "left_semi").drop("errors")
    validate = intake.validate_drops if shown.by_drop else intake.validate
    again = validate(touched, changes.where("stored"))
    same = shown.validated.join(changed, "order_code", "left_anti")
    validated = materialize(same.unionByName(again), "validated")
    counts = intake.preview_counts(validated).first()
    return Preview(validated, *counts, seen, shown.by_drop)


def load_batch(store: OrderStore, accepted: DataFrame, batch_id: int) -> None:
    """Write accepted rows and their new customers under a batch id, unpublished."""
    dimension = store.customers()
    store.write("customers", customers.additions(accepted, dimension), batch_id)
    extended = dimension.unionByName(store.written("customers", batch_id))
    store.write("orders", number_orders(accepted, extended, store.last_id("orders")), batch_id)


def import_orders(
    store: OrderStore,
    raw: DataFrame | Preview,
    sources: DataFrame | None = None,
    confirmed: bool = False,
    origin: str | None = None,
    report: str | None = None,
) -> ImportResult:
    """Validate a feed against the store and, once confirmed, load it as one batch.

    A preview of the feed is taken as it is; if the store has changed since, the
    orders that the change touches are validated again. ``report`` is where the reject report is written.

    Orders, customers and rejects are written first, and the manifest rows that
    publish them come last. A failure before that leaves the published store
    as it was and the input pending.
    """
    try:
        shown = raw if isinstance(raw, Preview) else preview(store, raw)
        if shown.seen != tuple(store.published()):
            shown = refresh(store, shown)
        skipped = shown.orders_to_skip
        if not confirmed:
            return ImportResult(
                False, True, 0, shown.invalid_orders, 0, False, domain.IMPORT_CANCELLED, skipped
            )
        if shown.total_orders == 0:
            return ImportResult(False, False, 0, 0, 0, False, domain.IMPORT_EMPTY)

        batch_id = store.next_batch()
        load_batch(store, intake.accepted(shown.validated), batch_id)
        store.write("rejects", skipped, batch_id)
        if report is not None:
            reports.write_report(shown.validated, report)
        store.publish(batch_id, ["customers", "orders", "rejects"], sources, origin)
    except Exception as error:
        log.exception("import failed")
        return ImportResult(False, False, 0, 0, 0, False, domain.IMPORT_FAILED % error)
    return ImportResult(
        True,
        False,
        shown.valid_orders,
        shown.invalid_orders,
        shown.invalid_orders,
        True,
        domain.IMPORT_DONE,
        skipped,
        store.written("orders", batch_id),
    )
