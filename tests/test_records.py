"""Records with line breaks in quotes: many tasks read what one task reads."""

from __future__ import annotations

import csv as library
import io
import random

import pytest
from pyspark.sql import functions as F

from orderloom.functions import domain
from orderloom.sources import csv, records

HEADER = "order_code,customer_name,quantity,status\n"
TINY = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "1"}


def in_one_task(spark, path):
    raw = csv.materialize(csv.read_orders(spark, path, multi_line=True), "drop")
    return [tuple(r) for r in csv.number_lines(raw).orderBy("pos").collect()]


def split(spark, path):
    return [tuple(r) for r in csv.load_orders(spark, path, multi_line=True).orderBy("pos").collect()]


def random_file(seed, rows):
    rng = random.Random(seed)
    pieces = ["a", " ", ",", '"', "\n", "\r\n", "long words here ", "é", '""', '",', ',"']
    out = io.StringIO()
    writer = library.writer(out, lineterminator=rng.choice(["\n", "\r\n"]), quoting=rng.choice([library.QUOTE_MINIMAL, library.QUOTE_ALL]))
    writer.writerow(rng.sample(domain.ORDER_FIELDS, 4))
    for i in range(rows):
        if rng.random() < 0.05:
            out.write("\n")
        fields = [f"C{i}"] + ["x" + "".join(rng.choices(pieces, k=rng.randrange(12))) for _ in range(3)]
        writer.writerow(fields[: rng.randrange(1, 5)] if rng.random() < 0.1 else fields)
    return out.getvalue()


@pytest.mark.parametrize("seed", range(6))
def test_equals_one_task(spark, tmp_path, settings, seed):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(random_file(f"{seed}{name}", 120), encoding="utf-8", newline="")
    expected = in_one_task(spark, str(tmp_path))
    settings(**TINY)
    lines = records.with_origin(spark.read.option("lineSep", "\n").text(str(tmp_path)))
    assert lines.select("file", "block").distinct().count() > 20 and lines.rdd.getNumPartitions() > 20
    assert split(spark, str(tmp_path)) == expected and len(expected) == 240


def test_a_field_longer_than_a_range(spark, tmp_path, settings):
    long = "\n".join(f'line {i} with ""quotes"", and commas' for i in range(200))
    (tmp_path / "a.csv").write_text(HEADER + f'A1,"{long}",1,pending\nA2,Berta,2,pending\n')
    settings(**TINY)
    assert split(spark, str(tmp_path)) == [
        (1, "A1", long.replace('""', '"'), "1", "pending"), (2, "A2", "Berta", "2", "pending")
    ]


def test_quotes_that_open_nothing(spark, tmp_path, settings):
    """A quote inside a plain field is a character, so the next line is a record of its own."""
    (tmp_path / "a.csv").write_text(HEADER + 'A1,6" pipe,1,pending\nA2,5" pipe,2,pending\nA3,"a\nb",3,pending\n')
    settings(**TINY)
    assert split(spark, str(tmp_path)) == [
        (1, "A1", '6" pipe', "1", "pending"), (2, "A2", '5" pipe', "2", "pending"), (3, "A3", "a\nb", "3", "pending")
    ]


def test_an_open_quote_is_named(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "LONGEST", 1000)
    (tmp_path / "a.csv").write_text(HEADER + 'A1,"open,1,pending\n' + "A2,Berta,2,pending\n" * 100)
    with pytest.raises(ValueError, match="a quote is not closed"):
        split(spark, str(tmp_path))


def test_carriage_returns(spark, tmp_path):
    rows = HEADER + 'A1,"a\nb",1,pending\nA2,b,2,pending\n'
    (tmp_path / "a.csv").write_text(rows.replace("\n", "\r\n"), newline="")
    assert split(spark, str(tmp_path)) == in_one_task(spark, str(tmp_path))
    assert split(spark, str(tmp_path))[0] == (1, "A1", "a\nb", "1", "pending")
    (tmp_path / "b.csv").write_text(rows.replace("\n", "\r"), newline="")
    with pytest.raises(ValueError, match="carriage returns alone"):
        split(spark, str(tmp_path))


def test_headers_bind_by_name_per_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿status,"order_code",extra,quantity\npending,A1,?,1,beyond\n')
    (tmp_path / "b.csv").write_text("\n" + HEADER + "B1,Berta,2,pending\n")
    (tmp_path / "c.csv").write_text(HEADER)
    (tmp_path / "d.csv").write_text("")
    assert split(spark, str(tmp_path)) == [(1, "A1", None, "1", "pending"), (2, "B1", "Berta", "2", "pending")]


def test_lines_are_functions_of_two_states(spark):
    cases = [("", 0, 1), ("a,b", 0, 1), ('a,"b', 1, 0), ('a,"b"', 0, 0), ('"', 1, 0), ('""', 0, 1), ('a"', 0, 0), ('x"",y', 0, 1), ('",', 1, 0), ('a,""', 0, 1), ('b"c,"d', 1, 1)]
    rows = spark.createDataFrame(cases, "value string, end0 int, end1 int")
    ends = [records._ends_inside(F.col("value"), s).cast("int").alias(f"f{s}") for s in (records._START, records._INSIDE)]
    for row in rows.select("*", *ends).collect():
        assert (row.f0, row.f2) == (row.end0, row.end1), row


def test_a_long_block_is_several_ranges(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text(random_file("long", 120), encoding="utf-8", newline="")
    expected = in_one_task(spark, str(tmp_path))
    monkeypatch.setattr(records, "_RANGE_LINES", 8)
    lines = records.with_origin(spark.read.option("lineSep", "\n").text(str(tmp_path)))
    sizes = records._located(lines).groupBy(*records._RANGE).count()
    assert lines.select("block").distinct().count() == 1 and sizes.agg(F.max("count")).first()[0] == 8
    assert split(spark, str(tmp_path)) == expected and len(expected) == 120
