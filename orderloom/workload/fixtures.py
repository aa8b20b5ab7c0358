"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import text
from orderloom.operators.storage import materialize, new_folder
from orderloom.plans.loading import import_orders
from orderloom.sources.store import OrderStore

# The update domain used on the events table, and its initial status.
EVENT_STATUSES = ("view", "click", "purchase")
EVENT_INITIAL = "view"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_with_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus"
    )
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    return orders.join(names, "o_custkey")


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a raw, partly damaged CSV row: blank and repeated codes, untidy text."""
    return orders_with_names(spark, sf_dir).selectExpr(
        "k AS pos",
        """CASE WHEN k % 23 = 0 THEN '  '
                WHEN k % 3 = 0 THEN concat(' ord', IF(k % 11 = 0, k - 1, k), ' ')
                ELSE concat('ORD', IF(k % 11 = 0, k - 1, k)) END AS order_code""",
        """CASE WHEN k % 29 = 0 THEN ''
                WHEN k % 31 = 0 THEN ' ab '
                WHEN k % 2 = 0 THEN concat('  ', upper(replace(c_name, '#', '   ')), ' ')
                ELSE replace(c_name, '#', ' ') END AS customer_name""",
        """CASE WHEN k % 37 = 0 THEN ''
                WHEN k % 41 = 0 THEN 'abc'
                WHEN k % 43 = 0 THEN '0'
                WHEN k % 47 = 0 THEN '-5'
                ELSE concat(' ', k % 50 + 1) END AS quantity""",
        """CASE WHEN k % 17 = 0 THEN 'shipped'
                WHEN o_orderstatus = 'F' THEN ' Completed '
                WHEN o_orderstatus = 'O' THEN 'PENDING'
                ELSE 'cancelled' END AS status""",
    )


def integer_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intake with an integer, signed or not, for every quantity."""
    quantity = F.expr("CASE WHEN trim(quantity) IN ('', 'abc') THEN ' -5 ' ELSE quantity END")
    return intake(spark, sf_dir).withColumn("quantity", quantity)


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders stored before the intake arrives, a second table beside it."""
    return orders_with_names(spark, sf_dir).where("k % 13 = 0").selectExpr(
        "k AS pos",
        "concat('ORD', k) AS order_code",
        "replace(c_name, '#', ' ') AS customer_name",
        "CAST(k % 50 + 1 AS STRING) AS quantity",
        """CASE o_orderstatus WHEN 'F' THEN 'completed'
                WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status""",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of the seeds."""
    orders = table(spark, sf_dir, "orders").where("o_orderkey % 13 = 0")
    return orders.select(F.concat(F.lit("ORD"), "o_orderkey").alias("order_code"))


_loaded: dict[tuple[str, str], OrderStore] = {}


_seeded: dict[tuple[str, str], OrderStore] = {}


def seeded_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """A store of the seeds for queries that only read it; built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _seeded:
        store = OrderStore(spark, new_folder(spark, "store"))
        result = import_orders(store, seeds(spark, sf_dir), confirmed=True)
        if not result.success:
            raise RuntimeError(result.message)
        _seeded[key] = store
    return _seeded[key]


def new_loaded_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """A store that imported the seeds and then the intake."""
    store = OrderStore(spark, new_folder(spark, "store"))
    for feed in (seeds(spark, sf_dir), intake(spark, sf_dir)):
        # Written, as an import reads its feed twice.
        result = import_orders(store, materialize(feed, "feed"), confirmed=True)
        if not result.success:
            raise RuntimeError(result.message)
    return store


def loaded_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """Such a store for queries that only read it; built once per session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _loaded:
        _loaded[key] = new_loaded_store(spark, sf_dir)
    return _loaded[key]


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part name as a customer name, in key order."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("pos"), F.col("p_name").alias("customer_name")
    )


def known_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension that already holds the customers of one market segment."""
    named = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    name = F.replace("c_name", F.lit("#"), F.lit(" "))
    return named.select(
        (F.col("c_custkey") + 1).alias("id"),
        name.alias("name"),
        text.customer_key(name).alias("normalized_name"),
    )


def legacy_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the old layout, with the raw customer name in every row."""
    named = intake(spark, sf_dir)
    return named.selectExpr(
        "pos AS id",
        "concat('ord', pos) AS order_code",
        "customer_name",
        "pos % 50 + 1 AS quantity",
        "status",
    )


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a log of create, update and delete commands."""
    return table(spark, sf_dir, "events").selectExpr(
        "ts",
        "event_id",
        "CAST(user_id AS STRING) AS order_code",
        """CASE event_type WHEN 'signup' THEN 'create'
                WHEN 'error' THEN 'delete' ELSE 'update' END AS op""",
        """CASE event_type WHEN 'click' THEN 'completed'
                WHEN 'purchase' THEN 'cancelled'
                WHEN 'error' THEN '' ELSE 'pending' END AS status""",
    )


def status_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as status updates; two of the event types are no known status."""
    return table(spark, sf_dir, "events").select(
        "ts", "event_id", F.col("user_id").cast("string").alias("order_code"),
        F.col("event_type").alias("status"),
    )


def tracked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored order per customer of the events, in the initial status."""
    users = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("order_code")
    )
    return users.withColumn("status", F.lit(EVENT_INITIAL))


def tracked_store(spark: SparkSession, sf_dir: str) -> OrderStore:
    """A store of the tracked orders."""
    store = OrderStore(spark, new_folder(spark, "store"))
    orders = tracked_orders(spark, sf_dir).select(
        F.col("order_code").cast("bigint").alias("id"),
        "order_code",
        F.lit(1).cast("bigint").alias("customer_id"),
        F.lit(1).cast("bigint").alias("quantity"),
        "status",
    )
    owner = spark.createDataFrame([(1, "Owner", "owner")], "id bigint, name string, normalized_name string")
    store.write("customers", owner, 0)
    store.write("orders", orders, 0)
    store.publish(0, ["customers", "orders"])
    return store
