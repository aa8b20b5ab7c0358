from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import decontam
from tests.llm.samples import clashing, documents, nothing, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(decontam.WORD, (text or "").translate(LOWER))


@pytest.fixture
def benchmark(spark):
    part = " ".join(prose(1, 200).split()[30:55])
    rows = [(1, part), (1, part), (2, "one"), (3, "TWO three"), (4, None), (None, "same " * 12), (5, "..."), (6, prose(3, 15)), (7, "not there at all")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def expected(text, items):
    own, hit, found = words(text), set(), set()
    for item, x in items:
        w = words(x)
        for k in range(max(1, len(w) - 9) if w else 0):
            window = w[k : k + 10]
            for i in range(len(own) - len(window) + 1):
                if own[i : i + len(window)] == window:
                    hit |= set(range(i, i + len(window)))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


@pytest.mark.parametrize("table, block", [(documents, 1000), (documents, 7), (clashing, 1000)])
def test_windows_against_brute_force(spark, benchmark, table, block):
    docs = table(spark)
    found = decontam.find_items(docs, benchmark, ("doc_id", "text"), block_windows=block)
    rows = found.select("*", decontam.hit_words(F.col("spans")).alias("hit")).collect()
    assert len(rows) == docs.count()
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    for row in rows:
        assert (row.n_words, row.hit, row["items"]) == expected(row.text, items)


def test_empty_sides(spark, benchmark):
    assert decontam.find_items(nothing(spark), benchmark).count() == 0
    rows = decontam.find_items(documents(spark), benchmark.limit(0)).collect()
    assert rows and all(r["spans"] == [] and r["items"] == [] for r in rows)
