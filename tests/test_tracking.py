"""Streamed commands against keyed state give what the batch operators give."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import browse
from orderloom.plans import lifecycle, loading, service
from orderloom.sources.store import OrderStore
from orderloom.streaming import tracking
from orderloom.workload.queries import QUERIES

SCHEMA = "seq bigint, tie bigint, order_code string, op string, status string"
ORDER = ["seq", "tie"]


def commands(seed, count):
    """Commands in order, many for one code and with ties in the first order column."""
    rng = random.Random(seed)
    out = []
    for i in range(count):
        code = "hot" if rng.random() < 0.3 else f"c{rng.randrange(12)} "
        op = rng.choice(["create", "update", "update", "update", "delete"])
        status = rng.choice(["pending", " Completed", "cancelled", "lost", None])
        out.append((i // 3, i % 3, code, op, status))
    return out


def put(folder, rows, start, size, seed=0):
    """Files of ``size`` commands each, shuffled inside, in the order of their times."""
    folder.mkdir(exist_ok=True)
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    for at in range(0, len(rows), size):
        chunk = rows[at : at + size]
        random.Random(seed + at).shuffle(chunk)
        path = folder / f"{start + at:06}.json"
        path.write_text("\n".join(json.dumps(dict(zip(names, row))) for row in chunk))
        os.utime(path, (1_700_000_000 + start + at,) * 2)


def source(spark, folder, files=None):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).json(str(folder))


def found(frame, *columns):
    return sorted(map(tuple, frame.select(*ORDER, *columns).collect()))


STORED = [("HOT", "pending"), ("C1", "completed"), ("C2", "cancelled"), ("NEVER ASKED", "pending")]


@pytest.mark.parametrize("size, files", [(24, 1), (40, 2), (200, None)])
def test_commands_equal_replay(spark, tmp_path, size, files):
    rows = commands(size, 200)
    stored = spark.createDataFrame(STORED, "order_code string, status string")
    put(tmp_path / "in", rows[:120], 0, size)
    run = lambda: tracking.collect_into(
        tracking.stream_commands(source(spark, tmp_path / "in", files), ORDER, stored), str(tmp_path / "out"), str(tmp_path / "ckpt")
    ).awaitTermination()
    run()
    put(tmp_path / "in", rows[120:], 120, size)
    for _ in range(2):  # goes on from its checkpoint, then finds nothing new
        run()
    columns = ("order_code", "op", "status", "old_status", "outcome")
    expected = lifecycle.replay(spark.createDataFrame(rows, SCHEMA), ORDER, stored)
    assert found(spark.read.parquet(str(tmp_path / "out")), *columns) == found(expected, *columns)
    assert len({r.outcome for r in expected.collect()}) == 6


def test_transitions_equal_batch(spark, tmp_path):
    rows = commands(5, 240)
    stored = spark.createDataFrame(STORED, "order_code string, status string")
    put(tmp_path / "in", rows, 0, 30)
    requests = source(spark, tmp_path / "in", 2).drop("op")
    stream = tracking.stream_transitions(requests, ORDER, stored)
    tracking.collect_into(stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    batch = lifecycle.update_statuses(spark.createDataFrame(rows, SCHEMA).drop("op"), stored, ORDER)
    columns = ("order_code", "old_status", "new_status")
    expected = found(lifecycle.transitions(batch, ORDER), *columns)
    assert found(spark.read.parquet(str(tmp_path / "out")), *columns) == expected and len(expected) > 20


def test_one_step_equals_the_rules_of_replay(spark):
    """Every state and command once, the state made by a command before it."""
    cases, rows = [], []
    for alive in (True, False):
        for op in ("create", "update", "delete"):
            for status in ("pending", "completed", "lost"):
                code = f"K{len(cases)}"
                rows += [(0, 0, code, "create", "pending")] if alive else []
                rows.append((1, 0, code, op, status))
                outcome, *_ = tracking.step(alive, "pending" if alive else None, op, status, status != "lost")
                cases.append((code, outcome))
    replayed = lifecycle.replay(spark.createDataFrame(rows, SCHEMA), ORDER).where("seq = 1")
    assert sorted(tuple(r) for r in replayed.select("order_code", "outcome").collect()) == sorted(cases)


def test_the_store_follows_the_stream(spark, tmp_path, feed, monkeypatch):
    """As the bulk update, also when the driver is lost between writing and publishing."""
    codes = ["HOT", *[f"C{i}" for i in range(9)]]
    orders = feed(*[(c, "Anna Verdi", "1", "pending") for c in codes])
    stores = [OrderStore(spark, str(tmp_path / n)) for n in ("streamed", "batched")]
    for store in stores:
        loading.import_orders(store, orders, confirmed=True)
    rows = commands(9, 160)
    put(tmp_path / "in", rows, 0, 80)
    clock = (F.col("seq") * 3 + F.col("tie")).cast("string")
    run = lambda: tracking.track_statuses(
        source(spark, tmp_path / "in", 1).drop("op"), stores[0], str(tmp_path / "ckpt"), ORDER, clock
    ).awaitTermination()
    publish, crashes = OrderStore.publish, [2]

    def broken(self, batch_id, *rest, **named):
        if batch_id in crashes:
            raise RuntimeError("driver lost")
        publish(self, batch_id, *rest, **named)

    monkeypatch.setattr(OrderStore, "publish", broken)
    with pytest.raises(Exception, match="driver lost"):
        run()
    crashes.clear()
    for _ in range(2):
        run()
    service.update_statuses(stores[1], spark.createDataFrame(rows, SCHEMA).drop("op"), ORDER, clock)
    histories = [sorted(map(tuple, s.history().collect())) for s in stores]
    assert histories[0] == histories[1] and len(histories[0]) > 20
    views = [browse.by_id(s.orders()).collect() for s in stores]
    assert views[0] == views[1]


def test_the_query_numbers_and_dates_its_transitions(spark, tmp_path):
    events = [(0, 5, "click"), (1, 5, "click"), (2, 7, "error"), (3, 5, "view"), (4, 9, "purchase"), (5, 7, "view")]
    rows = [(i, f"2024-01-0{i + 1} 10:00:0{i}", user, kind) for i, user, kind in events]
    table = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string")
    table.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(10).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    found = QUERIES["stream_transitions"](spark, str(tmp_path)).orderBy("id").collect()
    assert [tuple(row) for row in found] == [
        (1, "5", "view", "click", "2024-01-01 10:00:00", 0),
        (2, "5", "click", "view", "2024-01-04 10:00:03", 3),
        (3, "9", "view", "purchase", "2024-01-05 10:00:04", 4),
    ]


def test_orders_nobody_asks_for_make_no_state(spark, tmp_path):
    put(tmp_path / "in", [(0, 0, "HOT", "update", "completed"), (1, 0, "new", "create", "pending")], 0, 2)
    stored = spark.range(500).selectExpr("concat('C', id) AS order_code", "'pending' AS status")
    stored = stored.unionByName(spark.createDataFrame([*STORED, STORED[0]], "order_code string, status string"))
    stream = tracking.stream_commands(source(spark, tmp_path / "in"), ORDER, stored)
    query = tracking.collect_into(stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    query.awaitTermination()
    states = [operator["numRowsTotal"] for operator in json.loads(query.lastProgress.json)["stateOperators"]]
    assert found(spark.read.parquet(str(tmp_path / "out")), "order_code", "outcome") == [
        (0, 0, "HOT", "updated"), (1, 0, "NEW", "created")
    ]
    assert states == [2]
