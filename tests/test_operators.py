"""Skew-safe joins, dense ids and per-key sequences, against plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import checks, codes, customers, ids
from orderloom.operators import timeline as timeline_module
from orderloom.operators.timeline import Timeline
from orderloom.plans import history, lifecycle


@pytest.fixture
def uneven(spark):
    """1,000 rows; one key holds a third of them."""
    draw = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"k{draw.randrange(60)}") for i in range(1000)]
    return spark.createDataFrame(rows, "pos bigint, order_code string").repartition(7)


def test_a_hot_key_is_spread_over_chunks(spark, settings, monkeypatch):
    """One key holds nine rows in ten; positions and earlier values are those of one sequence."""
    monkeypatch.setattr(timeline_module, "TASK_ROWS", 1000)
    settings(**{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    rows = [(i, "hot" if i % 10 else f"k{i}", i if i % 4 == 0 else None) for i in range(4000)]
    frame = spark.createDataFrame(rows, "seq bigint, code string, v bigint").repartition(5)
    timeline = Timeline(frame, "code", ["seq"]).position("place").last_before(F.col("v"), "before")
    sizes = timeline._rows.where("code = 'hot'").groupBy("_chunk").count().collect()
    assert len(sizes) >= 6 and max(r["count"] for r in sizes) < 1200
    places, last = {}, {}
    for seq, code, v in rows:
        places[seq] = (places.get(code, 0) + 1, last.get(code))
        places[code] = places[seq][0]
        last[code] = last.get(code) if v is None else v
    assert {r.seq: (r.place, r.before) for r in timeline.rows().collect()} == {i: places[i] for i in range(4000)}


def test_few_codes_leave_a_large_store_where_it_is(spark, tmp_path):
    """A request of one row: neither the stored orders nor the history are shuffled or sorted."""
    spark.range(300_000).selectExpr("concat('C', id) AS order_code", "'pending' AS status", "id").write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    rows = [(1, "c7", "completed"), (2, "none", "completed")]
    spark.createDataFrame(rows, "pos bigint, order_code string, status string").write.parquet(str(tmp_path / "r"))
    asked = spark.read.parquet(str(tmp_path / "r"))
    outcomes = lifecycle.update_statuses(asked, stored, ["pos"])
    deletes = lifecycle.delete_outcomes(asked, stored)
    found = history.look_up(stored, stored, asked)
    assert [r.outcome for r in outcomes.orderBy("pos").collect()] == ["updated", "not_found"]
    assert [r.outcome for r in deletes.orderBy("pos").collect()] == ["deleted", "not_found"]
    assert sorted((r.order_code, r.success) for r in found.collect()) == [("C7", True), ("NONE", False)]
    asked_first = lifecycle._with_stored(lifecycle.normalize_requests(asked), stored)
    for frame in (asked_first, deletes, found):
        lines = frame._jdf.queryExecution().executedPlan().toString().split("\n")
        at = [i for i, line in enumerate(lines) if "FileScan" in line and "/s]" in line]
        for i in at:  # what stands right above a scan of the store is the broadcast semi-join
            above = [x for x in lines[max(0, i - 5) : i] if "Exchange" in x or "Join" in x]
            assert above and "BroadcastHashJoin" in above[-1] and "LeftSemi" in above[-1], [x[:120] for x in lines]


def test_repeated_codes(uneven):
    flagged = codes.flag_codes(uneven, None).collect()
    seen = set()
    for row in sorted(flagged, key=lambda row: row.pos):
        assert row.repeated == (row.order_code in seen)
        seen.add(row.order_code)
    assert len(flagged) == 1000
    assert {r.order_code for r in codes.first_rows(uneven).collect()} == seen


def test_first_positions_are_shuffled_once(spark, spread):
    """The codes asked of the registry come from the shuffle that the positions come from."""
    rows = [(1, "A"), (2, "A"), (None, "A"), (3, "B"), (None, "C"), (4, "")]
    orders = spark.createDataFrame(rows, "pos bigint, order_code string")
    known = spark.createDataFrame([("A",), ("C",), ("C",)], "order_code string")
    flagged = codes.flag_codes(orders, known)
    found = sorted((r.order_code, r.pos or 0, r.repeated, r.stored) for r in flagged.collect())
    assert found == [
        ("", 4, False, False),
        ("A", 0, True, False),
        ("A", 1, False, True),
        ("A", 2, True, False),
        ("B", 3, False, False),
        ("C", 0, True, False),
    ]
    assert "ReusedExchange" in flagged._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("partitions", ["1", "7", "64"])
def test_dense_ids_do_not_depend_on_partitions(spark, uneven, settings, partitions):
    settings(
        **{
            "spark.sql.shuffle.partitions": partitions,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    numbered = ids.dense_ids(uneven, ["order_code", F.desc("pos")], "id", after=10)
    expected = sorted(uneven.collect(), key=lambda r: (r.order_code, -r.pos))
    got = [(r.order_code, r.pos) for r in numbered.orderBy("id").collect()]
    assert got == [(r.order_code, r.pos) for r in expected]
    assert [r.id for r in numbered.select("id").orderBy("id").collect()] == list(range(11, 1011))


def test_dense_ids_of_nothing(uneven):
    assert ids.dense_ids(uneven.limit(0), ["pos"]).collect() == []


@pytest.mark.parametrize("partitions, most", [("1", 100), ("7", 100), ("64", 100), ("7", 1000)])
def test_timeline_equals_a_loop(uneven, settings, monkeypatch, partitions, most):
    monkeypatch.setattr(timeline_module, "TASK_ROWS", most)
    settings(
        **{
            "spark.sql.shuffle.partitions": partitions,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        }
    )
    value = F.when(F.col("pos") % 4 == 0, F.col("pos"))
    timeline = Timeline(uneven, "order_code", ["pos"])
    assert (timeline._edges is None) == (most == 1000)
    rows = timeline.last_before(value, "last").position("nth").rows()
    last, count = {}, {}
    for row in sorted(rows.collect(), key=lambda row: row.pos):
        assert row.last == last.get(row.order_code)
        count[row.order_code] = count.get(row.order_code, 0) + 1
        assert row.nth == count[row.order_code]
        if row.pos % 4 == 0:
            last[row.order_code] = row.pos
    assert sum(count.values()) == 1000


def named(spark, *names):
    return spark.createDataFrame(
        list(enumerate(names, 1)), "pos bigint, customer_name string"
    )


def test_equivalent_names_share_one_customer(spark):
    rows = named(spark, " Mario   Rossi ", "mario rossi", "Anna Verdi", "STRASSE", "straße")
    dimension = customers.build(rows)
    assert [tuple(r) for r in dimension.orderBy("id").collect()] == [
        (1, "Mario Rossi", "mario rossi"), (2, "Anna Verdi", "anna verdi"), (3, "STRASSE", "strasse"),
    ]
    resolved = customers.resolve(rows, dimension).orderBy("pos").collect()
    assert [r.customer_id for r in resolved] == [1, 1, 2, 3, 3]


def test_upsert_adds_only_new_customers_once(spark):
    first = customers.build(named(spark, "Mario Rossi", "Anna Verdi"))
    second = customers.upsert(named(spark, "ANNA  verdi", "Sara Neri", "sara neri"), first)
    assert [tuple(r) for r in second.orderBy("id").collect()][2:] == [(3, "Sara Neri", "sara neri")]
    assert customers.upsert(named(spark, "Sara Neri"), second).count() == 3


def test_search(spark):
    dimension = customers.build(named(spark, "Mario Rossi", "Anna Verdi", "100% Pure", r"a\b", "a_b"))

    def found(wanted):
        return [r.name for r in customers.search(dimension, wanted).collect()]

    assert found("ROSS") == ["Mario Rossi"]
    assert found("  anna   VERDI ") == ["Anna Verdi"]
    assert found("") == found(None) == ["100% Pure", r"a\b", "a_b", "Anna Verdi", "Mario Rossi"]
    assert found("a%i") == ["Anna Verdi", "Mario Rossi"]
    assert found("a_b") == [r"a\b", "a_b"]
    assert found("\\") == [r"a\b"]


def test_checks(spark):
    dimension = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    orders = spark.createDataFrame(
        [(1, "A", 1), (2, "A", 9), (3, None, 9)], "id bigint, order_code string, customer_id bigint"
    )
    assert [tuple(r) for r in checks.duplicate_keys(orders, "order_code").collect()] == [("A", 2)]
    assert [tuple(r) for r in checks.orphans(orders, dimension).collect()] == [(9, 2)]
    assert sorted(r.id for r in checks.unresolved(orders, dimension).collect()) == [2, 3]
    assert [tuple(r) for r in checks.restricted(dimension, orders).collect()] == [(1, "a", 1)]
    assert [r.id for r in checks.removable(dimension, orders).collect()] == [2]
    assert [r.id for r in checks.missing_fields(orders, "id", "order_code").collect()] == [3]
