"""Migration from the layout that embeds the customer name in every order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators import customers
from orderloom.plans.loading import ORDER_COLUMNS
from orderloom.sources.store import OrderStore


def is_legacy(orders: DataFrame) -> bool:
    """A table without ``customer_id`` has the old layout."""
    return "customer_id" not in orders.columns


def migrate(orders: DataFrame, dimension: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Split the names off into a dimension; ids, codes and statuses stay as they are."""
    placed = orders.withColumn("pos", F.col("id"))
    extended = (
        customers.build(placed) if dimension is None else customers.upsert(placed, dimension)
    )
    linked = customers.resolve(placed, extended)
    return linked.select(*ORDER_COLUMNS), extended


def current_layout(
    orders: DataFrame, dimension: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Migrate when the layout calls for it, else return the tables unchanged."""
    return migrate(orders, dimension) if is_legacy(orders) else (orders, dimension)


def migrate_into(store: OrderStore, orders: DataFrame) -> int:
    """Publish a table of the old layout in the store, once; returns how many orders it added.

    Ids, codes and statuses stay as they are. Orders whose id the store has
    already are left out, so a second run adds nothing. A table of the current
    layout is not taken.
    """
    if not is_legacy(orders):
        return 0
    known = store.written_ids("orders")
    missing = orders.join(known, "id", "left_anti")
    if missing.isEmpty():
        return 0
    dimension = store.customers()
    placed = missing.withColumn("pos", F.col("id"))
    batch_id = store.next_batch()
    store.write("customers", customers.additions(placed, dimension), batch_id)
    extended = dimension.unionByName(store.written("customers", batch_id))
    store.write("orders", customers.resolve(placed, extended).select(*ORDER_COLUMNS), batch_id)
    store.publish(batch_id, ["customers", "orders"])
    return store.written("orders", batch_id).count()
