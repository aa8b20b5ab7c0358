from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import mixing
from tests.llm.samples import clashing, documents, nothing


def expected_targets(sizes, mix):
    """Share by weight, cap, and share the rest again until nobody is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(names)}
    left, open_, out = sum(sizes.values()) * mix.percent / 100, set(names), dict.fromkeys(names, 0.0)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > mix.most * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = mix.most * sizes[s]
            left -= out[s]
        open_ -= over
    return out


@pytest.mark.parametrize("table, block", [(documents, 2048), (documents, 50), (clashing, 64)])
def test_targets_and_taken_words(spark, table, block):
    docs, mix = table(spark), mixing.Mix(block=block)
    placements, totals = mixing.mix_sources(docs, ("doc_id", "source", "text"), mix)
    rows = totals.collect()
    assert len(rows) == docs.count()
    sizes, taken = {}, {}
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
        assert 0 <= r.taken <= 2 * r.size
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    targets = expected_targets(sizes, mix)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for source, words in taken.items():
        assert abs(words - targets[source]) <= 0.5
    again = mixing.mix_sources(docs.repartition(3), ("doc_id", "source", "text"), mix)[1].collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert placements.agg(F.sum("words")).first()[0] == sum(taken.values())
    most = placements.groupBy("slot").agg(F.sum("words").alias("n"), F.countDistinct("source").alias("s")).collect()
    assert all(0 < r.n <= block and r.s <= 1 for r in most)


def test_schedule_stays_close_to_shares_everywhere(spark):
    needs = {"sa": 500, "sb": 300, "sc": 37, "sd": 1, "se": 0}
    rows = [(k, n) for k, n in needs.items()]
    slots = mixing.schedule(spark, spark.createDataFrame(rows, "source_key string, need bigint")).collect()
    order = [r.source_key for r in sorted(slots, key=lambda r: r.slot)]
    total = sum(needs.values())
    assert len({r.slot for r in slots}) == len(slots) == total
    for key, n in needs.items():
        assert sorted(r.rank for r in slots if r.source_key == key) == list(range(n))
    for upto in (50, 200, 400, 800):
        for key, n in needs.items():
            assert abs(order[:upto].count(key) - upto * n / total) <= 5


def test_no_rows_and_no_words(spark):
    assert mixing.mix_sources(nothing(spark))[1].count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [tuple(r) for r in mixing.mix_sources(blank)[1].orderBy("doc_id").collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
