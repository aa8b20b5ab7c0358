"""Integrity checks: each returns the violating rows, so an empty result passes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.storage import merged


def duplicate_keys(table: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with their row count (map-side combined)."""
    return table.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def orphans(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Distinct customer ids that orders use and the dimension lacks, with their order count."""
    used = orders.groupBy("customer_id").agg(F.count("*").alias("orders"))
    known = customers.select(F.col("id").alias("customer_id"))
    return used.join(merged(known), "customer_id", "left_anti")


def restricted(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers that must not be removed because orders point to them."""
    used = orders.groupBy(F.col("customer_id").alias("id")).agg(F.count("*").alias("orders"))
    return customers.select("id", "name").join(used, "id")


def removable(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers no order points to."""
    used = orders.select(F.col("customer_id").alias("id")).distinct()
    return customers.join(used, "id", "left_anti")


def missing_fields(table: DataFrame, *columns: str) -> DataFrame:
    """Rows with a null in a column that must hold a value."""
    broken = F.lit(False)
    for column in columns:
        broken = broken | F.col(column).isNull()
    return table.where(broken)


def unresolved(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The order rows behind ``orphans``."""
    known = customers.select(F.col("id").alias("customer_id"))
    return orders.join(known, "customer_id", "left_anti").select(*orders.columns)
