"""CSV drops: quoting, headers, file order; the export."""

from __future__ import annotations

import os

import pytest

from orderloom.functions import domain
from orderloom.sources import csv

HEADER = "order_code,customer_name,quantity,status\n"


def drop(folder, name, content):
    path = folder / name
    path.write_text(content, encoding="utf-8")
    return path


def rows(frame):
    return [tuple(row) for row in frame.orderBy("pos").select(*domain.ORDER_FIELDS).collect()]


@pytest.mark.parametrize("one_header", [False, True])
def test_fields_bind_by_name(spark, tmp_path, one_header):
    drop(tmp_path, "a.csv", "status,extra,order_code,customer_name\npending,?,A1,Anna\n")
    read = csv.load_orders(spark, str(tmp_path), one_header=one_header)
    assert rows(read) == [("A1", "Anna", None, "pending")]


def test_files_with_different_headers(spark, tmp_path):
    drop(tmp_path, "a.csv", HEADER + "A1,Anna,1,pending\nA2,Anna,2,pending\n")
    drop(tmp_path, "b.csv", "\nstatus,quantity,customer_name,order_code\ncompleted,3,Berta,B1\n")
    drop(tmp_path, "c.csv", HEADER + "C1,Carla,4,pending\n")
    assert rows(csv.load_orders(spark, str(tmp_path))) == [
        ("A1", "Anna", "1", "pending"), ("A2", "Anna", "2", "pending"),
        ("B1", "Berta", "3", "completed"), ("C1", "Carla", "4", "pending"),
    ]
    with pytest.raises(Exception, match="does not conform to the schema"):
        csv.load_orders(spark, str(tmp_path), one_header=True).collect()


def test_names_that_look_like_patterns(spark, tmp_path):
    drop(tmp_path, "a b.csv", HEADER + "A1,Anna,1,pending\n")
    drop(tmp_path, "c[1]%20{x}.csv", "status,quantity,customer_name,order_code\npending,2,Berta,B1\n")
    drop(tmp_path, "d*?.csv", HEADER + "D1,Dora,3,pending\n")
    read = rows(csv.load_orders(spark, str(tmp_path)))
    assert [r[0] for r in read] == ["A1", "B1", "D1"] and read[1] == ("B1", "Berta", "2", "pending")


def test_untidy_rows(spark, tmp_path):
    drop(
        tmp_path,
        "a.csv",
        HEADER
        + 'Q1,"Rossi, ""Mario""",1,pending\n'
        + 'Q2,"two\nlines",2,pending\n'
        + "\n"
        + "Q3,short\n"
        + "Q4,long,4,pending,more,and more\n"
        + "   \n"
        + "Q5,,,\n",
    )
    assert rows(csv.load_orders(spark, str(tmp_path), multi_line=True)) == [
        ("Q1", 'Rossi, "Mario"', "1", "pending"),
        ("Q2", "two\nlines", "2", "pending"),
        ("Q3", "short", None, None),
        ("Q4", "long", "4", "pending"),
        ("   ", None, None, None),
        ("Q5", None, None, None),
    ]


def test_empty_files(spark, tmp_path):
    drop(tmp_path, "a.csv", HEADER)
    assert rows(csv.load_orders(spark, str(tmp_path))) == []
    drop(tmp_path, "a.csv", "")
    assert rows(csv.load_orders(spark, str(tmp_path))) == []


@pytest.mark.parametrize("multi_line", [True, False])
def test_rows_keep_file_order(spark, tmp_path, settings, multi_line):
    settings(**{"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "1"})
    expected = []
    for name in ("a", "b", "c"):
        lines = [f"{name}{i},Customer {i},{i},pending" for i in range(300)]
        drop(tmp_path, f"{name}.csv", HEADER + "\n".join(lines) + "\n")
        expected += [f"{name}{i}" for i in range(300)]
    read = csv.load_orders(spark, str(tmp_path), multi_line=multi_line)
    if not multi_line:
        assert csv.read_orders(spark, str(tmp_path), multi_line=False).rdd.getNumPartitions() > 3
    got = read.orderBy("pos").collect()
    assert [row.order_code for row in got] == expected
    assert [row.pos for row in got] == list(range(1, 901))


def test_export(spark, tmp_path):
    orders = spark.createDataFrame(
        [(2, "B", 7, 'Rossi, "M" ', 2, "pending"), (1, "A", 7, " x\ny", 1, "completed")],
        "id bigint, order_code string, customer_id bigint, customer_name string, "
        "quantity bigint, status string",
    )
    folder = str(tmp_path / "export")
    for _ in range(2):
        assert csv.export_orders(orders, folder) == 2
    parts = sorted(name for name in os.listdir(folder) if name.endswith(".csv"))
    first = (tmp_path / "export" / parts[0]).read_text()
    assert first.startswith("id,order_code,customer_name,quantity,status\n")
    read = spark.read.csv(folder, header=True, escape='"', multiLine=True)
    assert sorted(tuple(row) for row in read.collect()) == [
        ("1", "A", " x\ny", "1", "completed"), ("2", "B", 'Rossi, "M" ', "2", "pending"),
    ]


def test_file_listing(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    drop(tmp_path, "a.csv", HEADER)
    drop(tmp_path / "sub", "b.csv", HEADER)
    drop(tmp_path, "note.txt", "x")
    listed = [row.source for row in csv.list_files(spark, str(tmp_path)).orderBy("source").collect()]
    assert [path.rsplit("/", 1)[1] for path in listed] == ["a.csv", "b.csv"]
