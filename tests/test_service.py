"""A store through its life: create, update, delete, re-create, look up."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.plans import loading, service
from orderloom.sources.store import OrderStore


@pytest.fixture
def store(spark, tmp_path, feed):
    made = OrderStore(spark, str(tmp_path / "store"))
    rows = feed(
        ("ORD1", "Mario Rossi", "12", "completed"), ("ORD2", "Luca Bianchi", "5", "pending")
    )
    assert loading.import_orders(made, rows, confirmed=True).success
    return made


@pytest.fixture
def update(spark, store):
    def run(*requests):
        rows = [(i, *request) for i, request in enumerate(requests, 1)]
        frame = spark.createDataFrame(rows, "seq bigint, order_code string, status string")
        return service.update_statuses(store, frame, ["seq"]).orderBy("seq").collect()

    return run


@pytest.fixture
def delete(spark, store):
    def run(*codes):
        frame = spark.createDataFrame(list(enumerate(codes)), "pos bigint, order_code string")
        return [r.outcome for r in service.delete_orders(store, frame).orderBy("pos").collect()]

    return run


def orders(store):
    return [(r.id, r.order_code, r.status) for r in service.all_orders(store).collect()]


def changes(store, code):
    rows = service.status_history(store, code).collect()
    return [(row.position, row.old_status, row.new_status) for row in rows]


def test_updates_change_orders_and_history_together(store, update):
    told = update((" ord2 ", " Completed "), ("ORD2", "cancelled"), ("ORD1", "completed"), ("X", "pending"))
    assert [row.outcome for row in told] == ["updated", "updated", "unchanged", "not_found"]
    assert orders(store) == [(1, "ORD1", "completed"), (2, "ORD2", "cancelled")]
    assert changes(store, "ord2") == [(1, "pending", "completed"), (2, "completed", "cancelled")]
    update(("ORD2", "pending"))
    assert orders(store)[1] == (2, "ORD2", "pending")
    assert changes(store, "ord2")[2] == (3, "cancelled", "pending")
    assert [row.id for row in store.history().orderBy("id").collect()] == [1, 2, 3]
    assert changes(store, "ORD1") == []


def test_deleted_order_keeps_history_and_its_code_can_return(store, update, delete, feed, spark):
    update(("ORD2", "cancelled"))
    assert delete(" ord2 ", "ORD2", "none") == ["deleted", "not_found", "not_found"]
    assert orders(store) == [(1, "ORD1", "completed")]
    assert changes(store, "ORD2") == [(1, "pending", "cancelled")]
    wanted = spark.createDataFrame([("ORD2",), ("none",)], "order_code string")
    answers = {r.order_code: r for r in service.look_up_history(store, wanted).collect()}
    assert answers["ORD2"].success and answers["ORD2"].current_status is None
    assert not answers["NONE"].success

    created = service.create_orders(store, feed(("ord2", "LUCA  bianchi", "1", "pending")))
    assert created.first().errors == []
    assert orders(store) == [(1, "ORD1", "completed"), (3, "ORD2", "pending")]
    assert service.list_customers(store).count() == 2
    update(("ORD2", "completed"))
    assert changes(store, "ORD2")[1:] == [(2, "pending", "completed")]
    assert orders(store)[1] == (3, "ORD2", "completed")


def test_creations(store, feed):
    checked = service.create_orders(
        store,
        feed(
            ("ORD1", "Anna", "1", "pending"),
            ("N1", "", "1", "pending"),
            ("N1", "Anna", "1", "pending"),
            ("n1", "Anna", "1", "pending"),
        ),
    )
    assert [row.errors for row in checked.orderBy("pos").collect()] == [
        [domain.STORED_CODE], [domain.MISSING_CUSTOMER], [], [domain.STORED_CODE],
    ]
    assert orders(store)[2:] == [(3, "N1", "pending")]


def test_failed_update_changes_nothing(store, update, monkeypatch):
    write = OrderStore.write

    def broken(self, table, rows, batch_id):
        if table == "history":
            raise RuntimeError("storage unavailable")
        write(self, table, rows, batch_id)

    monkeypatch.setattr(OrderStore, "write", broken)
    with pytest.raises(RuntimeError):
        update(("ORD2", "cancelled"))
    monkeypatch.undo()
    assert orders(store)[1] == (2, "ORD2", "pending") and changes(store, "ORD2") == []
    update(("ORD2", "completed"))
    assert changes(store, "ORD2") == [(1, "pending", "completed")]


def test_queries(store, tmp_path):
    found = service.search_order(store, " ord2 ").collect()
    assert [(r.id, r.customer_name) for r in found] == [(2, "Luca Bianchi")]
    browsed = service.browse_orders(store, customer_name="o", sort_by="quantity").collect()
    assert [row.order_code for row in browsed] == ["ORD1"]
    assert [row.name for row in service.search_customers(store, "luca").collect()] == ["Luca Bianchi"]
    counted = {row.status: row.orders for row in service.statistics(store).collect()}
    assert counted == {"completed": 1, "pending": 1, "cancelled": 0, "total": 2}
    assert service.export_orders(store, str(tmp_path / "export")) == 2


def test_left_over_of_a_failed_batch_is_replaced_whole(store, update, delete, spark):
    """An unpublished batch must not leak files of other tables into the next batch's id."""
    batch = store.next_batch()
    store.write("deletions", spark.createDataFrame([(1, "ORD1")], "id bigint, order_code string"), batch)
    assert orders(store)[0][0] == 1
    update(("ORD2", "completed"))
    assert [row[0] for row in orders(store)] == [1, 2]
    assert store.orders().where(F.col("id") == 1).count() == 1
