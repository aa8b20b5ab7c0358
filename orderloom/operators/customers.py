"""The customer dimension: one row per normalized name, with stable ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import text
from orderloom.operators.ids import dense_ids
from orderloom.operators.storage import materialize, merged

COLUMNS = ("id", "name", "normalized_name")


def with_keys(rows: DataFrame) -> DataFrame:
    """Add ``customer_key`` to rows with normalized names. Worth writing along when several steps need it."""
    return rows.withColumn("customer_key", text.casefold(F.col("customer_name")))


def _name(rows: DataFrame) -> Column:
    name = F.col("customer_name")
    return name if "customer_key" in rows.columns else text.customer_name(name)


def _key(rows: DataFrame) -> Column:
    if "customer_key" in rows.columns:
        return F.col("customer_key")
    return text.customer_key(F.col("customer_name"))


def first_spellings(rows: DataFrame) -> DataFrame:
    """One row per customer key with the spelling seen first (map-side combined)."""
    named = rows.select(
        _name(rows).alias("name"),
        _key(rows).alias("normalized_name"),
        "pos",
    )
    # Text is no hash aggregate's value, but it may be a key: first one row per spelling
    # (written, or the rows would be counted twice), and of these few the one that holds its customer's first position.
    spellings = materialize(named.groupBy("normalized_name", "name").agg(F.min("pos").alias("pos")), "spellings")
    firsts = spellings.groupBy("normalized_name").agg(F.min("pos").alias("first_pos"))
    pair = firsts.withColumn("pos", F.col("first_pos"))
    return spellings.join(pair, ["normalized_name", "pos"]).select("normalized_name", "name", "first_pos")


def new_customers(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """First spellings whose key the dimension lacks."""
    return first_spellings(rows).join(
        merged(customers.select("normalized_name")), "normalized_name", "left_anti"
    )


def assign_ids(spellings: DataFrame, after: int | Column = 0) -> DataFrame:
    """Ids in first-appearance order."""
    return dense_ids(spellings, ["first_pos"], "id", after).select(*COLUMNS)


def highest_id(table: DataFrame) -> int:
    """The highest id in use, 0 for an empty table."""
    return table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def build(rows: DataFrame) -> DataFrame:
    """A dimension from scratch."""
    return assign_ids(first_spellings(rows))


def additions(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """The dimension rows an upsert of ``rows`` adds, with ids after the highest one."""
    return assign_ids(new_customers(rows, customers), highest_id(customers))


def upsert(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """The dimension after every name in ``rows`` has a customer."""
    return customers.select(*COLUMNS).unionByName(additions(rows, customers))


def resolve(rows: DataFrame, customers: DataFrame) -> DataFrame:
    """Add ``customer_id`` by customer key. A customer may own any share of the rows."""
    keys = customers.select(F.col("id").alias("customer_id"), "normalized_name")
    keyed = rows.withColumn("normalized_name", _key(rows))
    return keyed.join(merged(keys), "normalized_name", "left").drop("normalized_name", "customer_key")


def search(customers: DataFrame, wanted: str | None) -> DataFrame:
    """Customers whose key contains the wanted text; ``%`` and ``_`` are wildcards.

    A blank text returns every customer. The pattern has no escape character,
    so backslashes are doubled for Spark's ``like``.
    """
    cleaned = " ".join((wanted or "").split()).casefold()
    listed = customers.select(*COLUMNS)
    if cleaned:
        pattern = "%" + cleaned.replace("\\", "\\\\") + "%"
        listed = listed.where(F.col("normalized_name").like(pattern))
    return listed.orderBy("normalized_name", "id")


def listing(customers: DataFrame) -> DataFrame:
    """Every customer in key order."""
    return search(customers, None)
