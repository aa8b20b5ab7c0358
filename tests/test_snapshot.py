"""Snapshots, kept counts, clustered files and the gate at publishing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.operators import browse
from orderloom.plans import history, loading, service
from orderloom.sources.store import OrderStore


@pytest.fixture
def store(spark, tmp_path, feed):
    made = OrderStore(spark, str(tmp_path / "store"))
    rows = [(f"ORD{i}", f"Anna Verdi {i % 3}", "1", ("pending", "completed")[i % 2]) for i in range(12)]
    assert loading.import_orders(made, feed(*rows), confirmed=True).success
    return made


def update(spark, store, *requests):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(requests)], "seq bigint, order_code string, status string")
    service.update_statuses(store, frame, ["seq"])


def delete(spark, store, *codes):
    service.delete_orders(store, spark.createDataFrame(list(enumerate(codes)), "pos bigint, order_code string"))


def state(store):
    return sorted(map(tuple, store.orders().select("id", "order_code", "customer_id", "quantity", "status").collect()))


def counted(store):
    full = {r.status: r.orders for r in browse.status_counts(store.orders()).collect()}
    assert {r.status: r.orders for r in service.statistics(store).collect()} == full
    return full


def test_equal_before_and_after_a_snapshot(spark, store, feed):
    update(spark, store, ("ORD1", "cancelled"), ("ORD2", "completed"), ("ORD1", "pending"))
    delete(spark, store, "ORD11", "ORD3", "NONE")
    before, numbers = state(store), counted(store)
    for rows in (5, 20_000_000):
        taken = store.snapshot(cluster_rows=rows)
        assert state(store) == before and counted(store) == numbers
    assert store.last_id("orders") == 12 and store.last_id("history") == 3
    update(spark, store, ("ORD2", "pending"), ("ORD3", "pending"))
    delete(spark, store, "ORD4")
    loading.import_orders(store, feed(("ORD3", "Anna Verdi", "5", "completed")), confirmed=True)
    after = {r[1]: r for r in state(store)}
    assert after["ORD3"][0] == 13 and after["ORD2"][4] == "pending" and "ORD4" not in after and len(after) == 10
    assert counted(store)["total"] == 10 and len(store.history().collect()) == 4
    # Nothing older than the snapshot is read for the current state.
    batches = {int(f.split("batch_id=")[1].split("/")[0]) for f in store.orders().inputFiles()}
    assert min(batches) == taken


def test_one_code_equals_the_whole(spark, store):
    update(spark, store, ("ORD1", "cancelled"))
    store.snapshot()
    update(spark, store, ("ORD1", "pending"), ("ORD5", "pending"))
    delete(spark, store, "ORD6")
    for code in ("ORD1", "ORD5", "ORD6", "ORD7", "NONE"):
        whole = store.orders().where(F.col("order_code") == code).collect()
        assert list(map(tuple, store.orders(code).select(*whole[0].__fields__).collect() if whole else store.orders(code).collect())) == list(map(tuple, whole))


def scanned(frame):
    """Rows that the file scans of a plan gave out, after row groups were skipped."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    plan = plan.finalPhysicalPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    leaves, total = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        leaf = leaf.plan() if "QueryStage" in leaf.getClass().getSimpleName() else leaf
        metrics = leaf.metrics()
        if metrics.contains("numFiles"):
            total += metrics.apply("numOutputRows").value()
    return total


def test_lookups_read_a_share_of_the_row_groups(spark, tmp_path, settings):
    settings(**{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    store = OrderStore(spark, str(tmp_path / "store"))
    codes = F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("ORD"), F.xxhash64("id") % 5000))
    changes = spark.range(20_000).select(
        (F.col("id") + 1).alias("id"), codes.alias("order_code"), F.lit("pending").alias("old_status"),
        F.lit("completed").alias("new_status"), F.lit("2026-01-01 00:00:00").alias("changed_at"),
    )
    store.write("history", changes.repartition(8), 0)
    store.publish(0, ["history"])
    found = history.for_code(store.history(), "ord17")
    expected = changes.where("order_code = 'ORD17'").orderBy("id").collect()
    assert list(map(tuple, found.collect())) == list(map(tuple, expected)) != []
    assert scanned(store.history().where("order_code = 'ORD17'")) <= 20_000 / 3
    hot = history.for_code(store.history(), "hot")
    assert hot.count() == 6667 and len(hot.inputFiles()) == 5


BAD = {
    "repeated code": [(20, "X", 1), (21, "X", 1)],
    "stored code": [(20, "ORD5", 1)],
    "repeated id": [(20, "X", 1), (20, "Y", 1)],
    "unknown customer": [(20, "X", 99)],
}


@pytest.mark.parametrize("kind", BAD)
def test_a_broken_batch_is_not_published(spark, store, kind):
    before, published = state(store), store.published()
    rows = [(i, code, customer, 1, "pending") for i, code, customer in BAD[kind]]
    batch = store.next_batch()
    store.write("orders", spark.createDataFrame(rows, "id bigint, order_code string, customer_id bigint, quantity bigint, status string"), batch)
    with pytest.raises(ValueError, match=kind):
        store.publish(batch, ["orders"])
    assert state(store) == before and store.published() == published


def test_customers_of_the_same_batch_count(spark, store):
    batch = store.next_batch()
    store.write("customers", spark.createDataFrame([(99, "New", "new")], "id bigint, name string, normalized_name string"), batch)
    rows = [(20, "X", 99, 1, "pending")]
    store.write("orders", spark.createDataFrame(rows, "id bigint, order_code string, customer_id bigint, quantity bigint, status string"), batch)
    store.publish(batch, ["customers", "orders"])
    assert counted(store)["total"] == 13


@pytest.mark.parametrize("by_drop", [False, True])
def test_a_stale_preview_equals_a_new_one(spark, store, feed, by_drop):
    """Codes loaded, deleted, and deleted and loaded again since; the others are not looked at again."""
    rows = [("NEW", "Anna Verdi", "1", "pending"), ("ord1", "Anna Verdi", "1", "pending"), ("ORD2", "Anna Verdi", "1", "pending"),
            ("ORD1", "Anna Verdi", "2", "pending"), ("LATE", "Anna Verdi", "1", "pending"), ("", "Nobody", "1", "pending"),
            ("NEW", "Berta Blu", "1", "pending"), ("ORD3", "", "1", "lost")]
    raw = feed(*rows).withColumn("drop", (F.col("pos") / 3).cast("int"))
    shown = loading.preview(store, raw, by_drop)
    before = max(store.published())
    delete(spark, store, "ORD1", "ORD2", "ORD3")
    loading.import_orders(store, feed(("LATE", "Zoe Blu", "1", "pending"), ("ORD2", "Zoe Blu", "1", "pending")), confirmed=True)
    update(spark, store, ("ORD5", "cancelled"))
    fresh, old = loading.preview(store, raw, by_drop), loading.refresh(store, shown)
    columns = ["pos", "order_code", "customer_name", "quantity", "status", "errors", "customer_key"]
    assert old.validated.select(columns).orderBy("pos").collect() == fresh.validated.select(columns).orderBy("pos").collect()
    assert (old.valid_orders, old.invalid_orders, old.seen) == (fresh.valid_orders, fresh.invalid_orders, fresh.seen)
    accepted = [sorted(r.order_code for r in p.orders_to_import.collect()) for p in (shown, old)]
    assert accepted == [["LATE", "NEW"], ["NEW", "ORD1"]]
    read = {int(f.split("batch_id=")[1].split("/")[0]) for f in store.code_changes(before).inputFiles()}
    assert min(read) > before
    assert loading.import_orders(store, shown, confirmed=True).saved == fresh.valid_orders
    assert counted(store)["total"] == len(state(store))


def test_nothing_changed_since(spark, store, feed):
    shown = loading.preview(store, feed(("NEW", "Anna Verdi", "1", "pending")))
    update(spark, store, ("ORD5", "cancelled"))
    again = loading.refresh(store, shown)
    assert again.validated is shown.validated and again.seen == tuple(store.published())
