"""Updates, deletes and replay, against sequential runs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.operators import timeline
from orderloom.plans import history, lifecycle

STORED = "order_code string, status string"
REQUESTS = "seq bigint, order_code string, status string"


@pytest.fixture
def stored(spark):
    return spark.createDataFrame([("ORD100", "pending")], STORED)


@pytest.fixture
def update(spark, stored):
    def run(*requests):
        rows = [(i, *request) for i, request in enumerate(requests, 1)]
        frame = spark.createDataFrame(rows, REQUESTS)
        return lifecycle.update_statuses(frame, stored, ["seq"])

    return run


def changes(outcomes):
    rows = lifecycle.transitions(outcomes, ["seq"]).orderBy("seq").collect()
    return [(row.order_code, row.old_status, row.new_status) for row in rows]


def test_update_is_recorded(update, stored):
    outcomes = update((" ord100 ", " Completed "))
    assert changes(outcomes) == [("ORD100", "pending", "completed")]
    assert lifecycle.current_statuses(outcomes, stored, ["seq"]).first().status == "completed"


def test_changes_are_ordered(update):
    outcomes = update(("ORD100", "completed"), ("ORD100", "cancelled"))
    assert changes(outcomes) == [
        ("ORD100", "pending", "completed"), ("ORD100", "completed", "cancelled"),
    ]


def test_unchanged_invalid_and_missing(update, stored):
    outcomes = update(("ORD100", "pending"), ("ORD100", "shipped"), ("none", "pending"))
    told = outcomes.withColumn("message", lifecycle.update_message()).orderBy("seq").collect()
    assert [row.outcome for row in told] == ["unchanged", "rejected", "not_found"]
    assert [row.message for row in told] == [
        "Order ORD100 updated successfully.",
        "Order ORD100 could not be updated.",
        "No order found with code NONE.",
    ]
    assert changes(outcomes) == []
    assert lifecycle.current_statuses(outcomes, stored, ["seq"]).first().status == "pending"


def test_audit_rows(update, spark):
    outcomes = update(("ORD100", "completed"), ("ORD100", "pending")).withColumn(
        "at", F.lit("2026-08-03 08:00:00.7").cast("timestamp")
    )
    rows = lifecycle.audit_rows(outcomes, ["seq"], F.col("at"), after=5).orderBy("id").collect()
    assert [tuple(row) for row in rows] == [
        (6, "ORD100", "pending", "completed", "2026-08-03 08:00:00"),
        (7, "ORD100", "completed", "pending", "2026-08-03 08:00:00"),
    ]


def test_delete(spark, stored):
    wanted = spark.createDataFrame(
        [(1, " ord100 "), (2, "ORD100"), (3, "missing")], "pos bigint, order_code string"
    )
    assert lifecycle.delete_orders(stored, wanted).count() == 0
    told = lifecycle.delete_outcomes(wanted, stored).orderBy("pos").collect()
    assert [row.outcome for row in told] == ["deleted", "not_found", "not_found"]
    assert [row.message for row in told] == [
        "Order ORD100 deleted successfully.",
        "No order found with code ORD100.",
        "No order found with code MISSING.",
    ]


@pytest.mark.parametrize("most", [1_000_000, 1])
def test_deletes_by_several_columns(spark, stored, monkeypatch, most):
    """The first request of a code wins, one given twice twice; no request is sorted to find a minimum."""
    monkeypatch.setattr(timeline, "TASK_ROWS", most)
    rows = [(2, None, "ord100"), (2, 5, "ord100"), (1, 7, " ORD100"), (1, 7, "ord100"), (1, 1, "gone"), (3, 1, None)]
    plain = spark.createDataFrame(rows, "a bigint, b bigint, order_code string")
    wanted = plain.select(F.when(F.col("a") < 3, F.struct("a", "b")).alias("pos"), "order_code")
    told = lifecycle.delete_outcomes(wanted, stored.union(stored))
    found = sorted((r.pos.a if r.pos else 0, r.order_code, r.outcome) for r in told.collect())
    assert found == [
        (0, "", "not_found"),
        (1, "GONE", "not_found"),
        (1, "ORD100", "deleted"),
        (1, "ORD100", "deleted"),
        (2, "ORD100", "not_found"),
        (2, "ORD100", "not_found"),
    ]
    assert ("SortAggregate" in told._jdf.queryExecution().toString()) == (most == 1)


def test_requests_are_joined_once(spark, stored):
    """The store is cut by the counted codes: beside these the requests are read once."""
    asked = spark.range(40).selectExpr("id AS seq", "'ord100' AS order_code", "'completed' AS status")
    plan = lifecycle.update_statuses(asked, stored, ["seq"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (0, 40") == 1


def test_history_outlives_its_order(update, stored, spark):
    audit = lifecycle.audit_rows(update(("ORD100", "completed")), ["seq"], F.current_timestamp())
    wanted = spark.createDataFrame([(" ord100 ",), ("missing",)], "order_code string")

    def answers(orders):
        rows = history.look_up(audit, orders, wanted).collect()
        return {row.order_code: tuple(row)[1:] for row in rows}

    found = "Found 1 status changes for order ORD100."
    missing = (False, None, 0, "No order or status history found for code MISSING.")
    after = stored.withColumn("status", F.lit("completed"))
    assert answers(after) == {"ORD100": (True, "completed", 1, found), "MISSING": missing}
    assert answers(stored.limit(0)) == {"ORD100": (True, None, 1, found), "MISSING": missing}
    assert [tuple(r) for r in history.retained(audit, stored.limit(0)).collect()] == [("ORD100", 1)]
    assert history.retained(audit, stored).count() == 0
    assert [r.position for r in history.with_positions(audit).collect()] == [1]
    assert history.for_code(audit, "ord100").count() == 1


def run_log(log, orders):
    """One command after another."""
    orders, outcomes = dict(orders), []
    for seq, code, op, status in log:
        code, status = code.strip().upper(), status.strip().lower()
        old, valid = orders.get(code), status in domain.STATUSES
        if op == "create":
            outcome = "rejected" if old is not None or not valid else "created"
        elif old is None:
            outcome = "not_found"
        elif op == "delete":
            outcome = "deleted"
        elif not valid:
            outcome = "rejected"
        else:
            outcome = "unchanged" if old == status else "updated"
        if outcome in ("created", "updated"):
            orders[code] = status
        if outcome == "deleted":
            del orders[code]
        outcomes.append((seq, old, outcome))
    return outcomes, orders


@pytest.mark.parametrize("skewed", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_replay_equals_a_sequential_run(spark, skewed, seed, request):
    if skewed:
        request.getfixturevalue("spread")
    draw = random.Random(seed)
    log = [
        (
            seq,
            draw.choice(["HOT", "hot ", f"C{draw.randrange(25)}"]),
            draw.choice(["create", "update", "update", "update", "delete"]),
            draw.choice(["pending", "Completed ", "cancelled", "shipped"]),
        )
        for seq in range(600)
    ]
    before = {"HOT": "pending", "C3": "completed", "IDLE": "pending"}
    frame = spark.createDataFrame(log, "seq bigint, order_code string, op string, status string")
    stored = spark.createDataFrame(list(before.items()), STORED)
    replayed = lifecycle.replay(frame.repartition(5), ["seq"], stored)
    outcomes, after = run_log(log, before)
    rows = replayed.orderBy("seq").collect()
    assert [(row.seq, row.old_status, row.outcome) for row in rows] == outcomes
    live = lifecycle.live_orders(replayed, ["seq"], stored).collect()
    assert {row.order_code: row.status for row in live} == after

    alone = lifecycle.replay(frame, ["seq"])
    outcomes, after = run_log(log, {})
    assert [(r.seq, r.old_status, r.outcome) for r in alone.orderBy("seq").collect()] == outcomes
    live = lifecycle.live_orders(alone, ["seq"]).collect()
    assert {row.order_code: row.status for row in live} == after
