"""Status history: lookups, numbering, and history beside the current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import domain, text
from orderloom.operators.timeline import Timeline


def for_code(history: DataFrame, code: str) -> DataFrame:
    """The changes of one order, oldest first."""
    wanted = (code or "").strip().upper()
    return history.where(F.col("order_code") == wanted).orderBy("id")


def with_positions(history: DataFrame) -> DataFrame:
    """Each change numbered from 1 within its order."""
    return Timeline(history, "order_code", ["id"]).position("position").rows()


def change_counts(history: DataFrame) -> DataFrame:
    return history.groupBy("order_code").agg(F.count("*").alias("changes"))


def with_current(history: DataFrame, orders: DataFrame) -> DataFrame:
    """Every code that has an order or a history: current status (null once deleted) and changes."""
    current = orders.select("order_code", F.col("status").alias("current_status"))
    return (
        change_counts(history)
        .join(current, "order_code", "full_outer")
        .select("order_code", "current_status", F.coalesce("changes", F.lit(0)).alias("changes"))
    )


def look_up(history: DataFrame, orders: DataFrame, codes: DataFrame) -> DataFrame:
    """The answer for every requested code, found or not."""
    wanted = codes.select(text.order_code(F.col("order_code")).alias("order_code"))
    own = [t.join(wanted, "order_code", "left_semi") for t in (history, orders)]
    known = with_current(*own).withColumn("success", F.lit(True))
    code, found = F.col("order_code"), F.coalesce("success", F.lit(False))
    changes = F.coalesce("changes", F.lit(0))
    return wanted.join(known, "order_code", "left").select(
        "order_code",
        found.alias("success"),
        "current_status",
        changes.alias("changes"),
        F.when(found, F.format_string(domain.FOUND_HISTORY, changes, code))
        .otherwise(F.format_string(domain.NO_HISTORY, code))
        .alias("message"),
    )


def retained(history: DataFrame, orders: DataFrame) -> DataFrame:
    """History counts of codes whose order is gone."""
    return change_counts(history).join(
        orders.select("order_code"), "order_code", "left_anti"
    )
