"""Streams give what the batch operators give, however many drops a micro-batch takes."""

from __future__ import annotations

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.operators import browse
from orderloom.plans import loading, service
from orderloom.sources import csv
from orderloom.sources.store import OrderStore
from orderloom.streaming.drops import announce
from orderloom.streaming.inbox import stream_intake
from orderloom.streaming.statuses import stream_statuses

HEADER = ",".join(domain.ORDER_FIELDS) + "\n"


def contents(store):
    joined = browse.order_view(store.orders(), store.customers())
    return [tuple(row) for row in browse.by_id(joined).collect()]


def drop(spark, tmp_path, name, *files):
    folder = tmp_path / "inbox" / name
    folder.mkdir(parents=True)
    for number, content in enumerate(files):
        (folder / f"{number}.csv").write_text(content)
    announce(spark, str(tmp_path / "markers"), name, str(folder))
    return str(folder)


DROPS = [
    [HEADER + "A1,,1,pending\n", HEADER + "A1,Anna Verdi,1,pending\nA2,Anna Verdi,1,pending\n"],
    ["status,order_code,quantity,customer_name\npending,a2,1,Anna\npending,B1,2,ANNA  VERDI\n", HEADER + "B1,Berta Blu,1,pending\n"],
    [HEADER],
    [HEADER + "A1,Carla Neri,7,completed\n"],
]


@pytest.mark.parametrize("most", [None, 1])
def test_inbox_stream_equals_batch_imports(spark, tmp_path, most):
    streamed = OrderStore(spark, str(tmp_path / "streamed"))
    batched = OrderStore(spark, str(tmp_path / "batched"))
    run = lambda: stream_intake(
        spark, str(tmp_path / "markers"), streamed, str(tmp_path / "ckpt"), most
    ).awaitTermination()
    for number, files in enumerate(DROPS):
        folder = drop(spark, tmp_path, f"drop{number}", *files)
        loading.import_orders(batched, csv.load_orders(spark, folder), confirmed=True)
        if number == 1:
            run()
    for _ in range(2):
        run()
    assert contents(streamed) == contents(batched) != []
    reasons = [sorted(r.reasons for r in s.rejects().collect()) for s in (streamed, batched)]
    assert reasons[0] == reasons[1] and len(reasons[0]) == 4
    assert streamed.consumed().count() == 5


def test_failed_drop_is_retried(spark, tmp_path, monkeypatch):
    drop(spark, tmp_path, "one", HEADER + "A1,Anna Verdi,1,pending\n")
    store = OrderStore(spark, str(tmp_path / "store"))
    run = lambda: stream_intake(spark, str(tmp_path / "markers"), store, str(tmp_path / "ckpt")).awaitTermination()
    write = OrderStore.write

    def broken(self, table, rows, batch_id):
        if table == "rejects":
            raise RuntimeError("storage unavailable")
        write(self, table, rows, batch_id)

    monkeypatch.setattr(OrderStore, "write", broken)
    with pytest.raises(StreamingQueryException):
        run()
    assert contents(store) == []
    monkeypatch.undo()
    for _ in range(2):
        run()
    assert len(contents(store)) == 1 and store.published() == [0]


def test_batch_and_stream_share_a_store(spark, tmp_path, feed):
    store = OrderStore(spark, str(tmp_path / "store"))
    loading.import_orders(store, feed(("Z9", "Zoe Blu", "1", "pending")), confirmed=True)
    drop(spark, tmp_path, "one", HEADER + "A1,Anna Verdi,1,pending\nz9,Zoe,1,pending\n")
    stream_intake(spark, str(tmp_path / "markers"), store, str(tmp_path / "ckpt")).awaitTermination()
    assert [row[:2] for row in contents(store)] == [(1, "Z9"), (2, "A1")]


@pytest.mark.parametrize("most", [None, 1])
def test_status_stream_equals_batch(spark, tmp_path, feed, most):
    """Drops of several files with overlapping times, and requests for an order that is not there."""
    names = ["HOT", *[f"C{i}" for i in range(17)]]
    orders = feed(*[(n, "Anna Verdi", "1", ("pending", "completed")[i % 2]) for i, n in enumerate(names)])
    stores = [OrderStore(spark, str(tmp_path / n)) for n in ("streamed", "batched")]
    for store in stores:
        loading.import_orders(store, orders, confirmed=True)
    pick = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 19))
    states = F.array(*map(F.lit, ("pending", "Completed", "cancelled", "lost")))
    status = F.element_at(states, (F.xxhash64("id") % 4 + 4).cast("int") % 4 + 1)
    requests = spark.range(600).select(F.col("id").alias("seq"), pick.alias("order_code"), status.alias("status"))
    clock = F.col("seq").cast("string")
    for number, low in enumerate((0, 200, 400)):
        part = requests.where(f"seq >= {low} AND seq < {low + 200}")
        folder = str(tmp_path / "requests" / str(number))
        part.repartition(8).write.parquet(folder)
        announce(spark, str(tmp_path / "markers"), f"drop{number}", folder)
    for _ in range(2):
        stream_statuses(
            spark, str(tmp_path / "markers"), stores[0], str(tmp_path / "ckpt"), requests.schema, ["seq"], clock,
            drops_per_trigger=most,
        ).awaitTermination()
    service.update_statuses(stores[1], requests, ["seq"], clock)
    histories = [sorted(map(tuple, s.history().collect())) for s in stores]
    assert histories[0] == histories[1] and len(histories[0]) > 100
    assert {r[1] for r in histories[0]} == set(names)
    assert contents(stores[0]) == contents(stores[1])
