"""The stream of order files gives what importing the files one after another gives."""

from __future__ import annotations

import os

import pytest
from pyspark.errors import StreamingQueryException

from orderloom.functions import domain
from orderloom.operators import browse
from orderloom.plans import intake, loading
from orderloom.sources import csv
from orderloom.sources.store import OrderStore
from orderloom.streaming.orders import run_inbox, stream_orders, sweep

HEADER = ",".join(domain.ORDER_FIELDS) + "\n"

FILES = [
    HEADER + "A1,,1,pending\nA1,Anna Verdi,1,pending\nA2,Anna Verdi,1,pending\n,Nobody,1,pending\n",
    'status,order_code,quantity,customer_name\npending,a1,1,Anna\npending,B1,2,"ANNA\n VERDI"\npending,A2,1,Anna\n',
    HEADER + "B1,Berta Blu,1,pending\nC1,Carla Neri,x,pending\n",
    HEADER,
    HEADER + "C1,Carla Neri,7,completed\nC1,Carla,7,completed\n,Nobody,1,pending\nA1,Dora,1,pending\n",
]


def put(folder, name, content, age):
    """Place a file whole, with a modification time of its own."""
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text(content)
    os.utime(path, (1_700_000_000 + age, 1_700_000_000 + age))
    return path


def contents(store):
    view = browse.by_id(browse.order_view(store.orders(), store.customers()))
    rejects = store.rejects().select("order_code", "customer_name", "status", "reasons").collect()
    return [tuple(r) for r in view.collect()], sorted(map(tuple, rejects))


def one_by_one(spark, tmp_path, paths):
    store = OrderStore(spark, str(tmp_path / "single"))
    for path in paths:
        raw = csv.load_orders(spark, str(path), multi_line=True)
        loading.import_orders(store, raw, confirmed=True)
    return contents(store)


def test_equals_imports_one_by_one(spark, tmp_path):
    # Names and times disagree: time decides.
    paths = [put(tmp_path / "inbox", f"{9 - i}.csv", text, i) for i, text in enumerate(FILES)]
    expected = one_by_one(spark, tmp_path, paths)
    assert len(expected[0]) == 4 and len(expected[1]) == 9
    for most, batches in ((None, 1), (2, 3)):
        store = OrderStore(spark, str(tmp_path / f"store{most}"))
        for _ in range(2):
            run_inbox(spark, str(tmp_path / "inbox"), store, str(tmp_path / f"ckpt{most}"), most)
        assert contents(store) == expected and len(store.published()) == batches
    assert store.pending(csv.list_files(spark, str(tmp_path / "inbox"))).isEmpty()


def test_a_crash_before_publishing_changes_nothing_twice(spark, tmp_path, monkeypatch):
    paths = [put(tmp_path / "inbox", f"{i}.csv", text, i) for i, text in enumerate(FILES[:2])]
    store = OrderStore(spark, str(tmp_path / "store"))
    publish, crashes = OrderStore.publish, [1]

    def broken(self, batch_id, *rest):
        if crashes and batch_id == crashes[0]:
            raise RuntimeError("driver lost")
        publish(self, batch_id, *rest)

    monkeypatch.setattr(OrderStore, "publish", broken)
    run = lambda: run_inbox(spark, str(tmp_path / "inbox"), store, str(tmp_path / "ckpt"), 1)
    with pytest.raises(StreamingQueryException):
        run()
    assert store.published() == [0]
    crashes.clear()
    run()
    assert contents(store) == one_by_one(spark, tmp_path, paths)


def test_a_micro_batch_that_runs_again_changes_nothing(spark, tmp_path):
    """The store published, but the checkpoint did not notice."""
    put(tmp_path / "inbox", "a.csv", FILES[0], 0)
    store = OrderStore(spark, str(tmp_path / "store"))
    for checkpoint in ("ckpt", "another"):
        stream_orders(spark, str(tmp_path / "inbox"), store, str(tmp_path / checkpoint)).awaitTermination()
    commit = tmp_path / "ckpt" / "commits" / "0"
    commit.unlink()
    (commit.parent / ".0.crc").unlink(missing_ok=True)
    stream_orders(spark, str(tmp_path / "inbox"), store, str(tmp_path / "ckpt")).awaitTermination()
    assert store.published() == [0]


def test_a_file_written_anew_is_pending_again(spark, tmp_path):
    inbox, store = tmp_path / "inbox", OrderStore(spark, str(tmp_path / "store"))
    put(inbox, "new.csv", HEADER + "A1,Anna Verdi,1,pending\n", 0)
    put(inbox, "empty.csv", "", 0)
    put(inbox, "still.csv", HEADER + "S1,Susi Sorglos,1,pending\n", 0)
    run = lambda: run_inbox(spark, str(inbox), store, str(tmp_path / "ckpt"))
    run()
    listed = csv.list_files(spark, str(inbox))
    assert store.pending(listed).isEmpty() and sweep(spark, store, listed) == 0
    put(inbox, "new.csv", HEADER + "A1,Anna Verdi,1,pending\nA2,Anna,2,pending\n", 10)
    put(inbox, "empty.csv", HEADER + "E1,Erna Eins,1,pending\n", 10)
    listed = csv.list_files(spark, str(inbox))
    names = lambda files: sorted(r.source.rsplit("/", 1)[1] for r in files.collect())
    assert names(store.pending(listed)) == ["empty.csv", "new.csv"]
    for _ in range(2):
        run()
    orders, rejects = contents(store)
    assert sorted(r[1] for r in orders) == ["A1", "A2", "E1", "S1"]
    assert [r[0] for r in rejects] == ["A1"] and store.pending(listed).isEmpty()


def test_same_length_and_path_but_later(spark, tmp_path):
    inbox, store = tmp_path / "inbox", OrderStore(spark, str(tmp_path / "store"))
    put(inbox, "new.csv", HEADER + "A1,Anna Verdi,1,pending\n", 0)
    loading.import_orders(
        store, csv.load_orders(spark, str(inbox)), csv.list_files(spark, str(inbox)), confirmed=True
    )
    put(inbox, "new.csv", HEADER + "A2,Anna Verdi,1,pending\n", 1)
    assert sweep(spark, store, csv.list_files(spark, str(inbox))) == 1 and len(contents(store)[0]) == 2


def test_paths_without_a_version_are_consumed_for_good(spark, tmp_path, feed):
    inbox, store = tmp_path / "inbox", OrderStore(spark, str(tmp_path / "store"))
    put(inbox, "a.csv", HEADER, 0)
    files = csv.list_files(spark, str(inbox))
    loading.import_orders(store, feed(("A1", "Anna", "1", "pending")), files.select("source"), confirmed=True)
    put(inbox, "a.csv", HEADER + "A2,Anna Verdi,1,pending\n", 1)
    assert store.pending(csv.list_files(spark, str(inbox))).isEmpty()


def test_finished_files_are_archived(spark, tmp_path):
    inbox, store = tmp_path / "inbox", OrderStore(spark, str(tmp_path / "store"))
    for number in range(3):
        put(inbox, f"{number}.csv", HEADER + f"A{number},Anna Verdi,1,pending\n", number)
        run_inbox(spark, str(inbox), store, str(tmp_path / "ckpt"), archive=str(tmp_path / "archive"))
    archived = [p.name for p in (tmp_path / "archive").rglob("*.csv")]
    assert "0.csv" in archived and len(contents(store)[0]) == 3


def test_drops_see_the_drops_before_them(spark, registry):
    rows = [
        (1, 1, "A", "Anna", "x", "pending"), (2, 1, "A", "Anna", "1", "pending"), (3, 2, "a", "Anna", "1", "pending"),
        (4, 3, "A", "Anna", "1", "pending"), (5, 3, "", "Anna", "1", "pending"), (6, 4, "", "Anna", "1", "pending"),
        (7, 4, "S", "Anna", "1", "pending"), (8, 5, "S", "Anna", "1", "pending"),
    ]
    raw = spark.createDataFrame(rows, "pos bigint, drop int, order_code string, customer_name string, quantity string, status string")
    checked = intake.validate_drops(raw, registry("S")).orderBy("pos").collect()
    number, repeated, stored, missing = domain.QUANTITY_NOT_A_NUMBER, domain.REPEATED_CODE, domain.STORED_CODE, domain.MISSING_CODE
    assert [r.errors for r in checked] == [[number], [repeated], [], [stored], [missing], [missing], [stored], [stored]]
