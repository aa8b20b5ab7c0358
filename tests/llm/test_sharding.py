"""Shards against a plain sort of all rows."""

from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from orderloom.llm import sharding
from orderloom.operators.storage import materialize
from tests.llm.samples import clashing, documents, nothing

SMALL = sharding.Sharding(shards=3, range_rows=4)


def by_hand(rows, shards, whole):
    """(id, size, crc32, shard, slot) of all rows in key order; ``rows`` are (text hash, id hash, id, text)."""
    rows = sorted(rows, key=lambda r: r[:2])
    sizes = [len((t or "").encode()) + 1 for *_, t in rows]
    starts = [sum(sizes[:i]) for i in range(len(sizes))]
    total = sum(sizes)
    small = max(max(sizes), total // (shards * whole))
    edges = []
    for k in range(1, shards):
        cut = total * k // shards
        at = max(i for i, s in enumerate(starts) if s <= cut)
        group = [i for i, r in enumerate(rows) if r[0] == rows[at][0]]
        low, high = starts[group[0]], starts[group[-1]] + sizes[group[-1]]
        if high - low > small:
            low, high = starts[at], starts[at] + sizes[at]
        edges.append(low if cut - low <= high - cut else high)
    out, counts = [], [0] * shards
    for (*_, key, text), size, start in zip(rows, sizes, starts):
        shard = sum(start >= e for e in edges)
        out.append((key, size, zlib.crc32((text or "").encode()), shard, counts[shard]))
        counts[shard] += 1
    return out


def hashed(docs):
    text = F.coalesce("text", F.lit("")).cast("binary")
    return [tuple(r) for r in docs.select(F.xxhash64(text), F.xxhash64("doc_id"), "doc_id", "text").collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[3], r[4]))


@pytest.mark.parametrize("how", [SMALL, sharding.Sharding(), sharding.Sharding(shards=1)])
@pytest.mark.parametrize("table", [documents, clashing])
def test_equals_plain_sort(spark, monkeypatch, table, how):
    monkeypatch.setattr(sharding, "LEAST_ROWS", 2)
    docs = table(spark)
    found = order(tuple(r) for r in sharding.shard(docs, how=how).collect())
    assert found == order(by_hand(hashed(docs), how.shards, how.whole))


def test_a_third_is_one_text_and_ids_are_missing(spark, monkeypatch):
    """The group is cut where it must be, its ranges are divided, and sizes are near equal."""
    monkeypatch.setattr(sharding, "LEAST_ROWS", 20)
    hot = F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.repeat(F.col("id").cast("string"), (F.col("id") % 9 + 1).cast("int")))
    docs = spark.range(6000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), hot.alias("text"))
    found = [tuple(r) for r in sharding.shard(docs).collect()]
    assert order(found) == order(by_hand(hashed(docs), 8, 50))
    share = sum(r[1] for r in found) / 8
    sums = [sum(r[1] for r in found if r[3] == s) for s in range(8)]
    assert max(abs(s - share) for s in sums) <= share / 50
    rows, ranges = sharding.ranged(materialize(sharding.sized_rows(docs, ()), "sized"), sharding.Sharding())
    assert ranges.agg(F.max("rows")).first()[0] <= 2 * max(20, 6000 >> sharding.FAN_BITS)


def test_huge_texts_do_not_hide_small_rows(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST_ROWS", 20)
    text = F.when(F.col("id") == 7, F.repeat(F.lit("long "), 400_000)).otherwise(F.col("id").cast("string"))
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), text.alias("text"))
    assert order(tuple(r) for r in sharding.shard(docs).collect()) == order(by_hand(hashed(docs), 8, 50))


def test_few_rows_and_none(spark):
    docs = documents(spark).limit(2)
    assert sorted(r.slot for r in sharding.shard(docs).collect()) in ([0, 0], [0, 1])
    assert sharding.shard(nothing(spark)).collect() == []


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = documents(spark).withColumns({"shard": F.lit("x"), "slot": F.lit(1), "size": F.lit(None).cast("int")})
    written = sharding.write_shards(docs, str(tmp_path / "shards"), SMALL)
    as_they_were = sorted(map(repr, docs.collect()))
    assert sorted(map(repr, written.select(docs.columns).collect())) == as_they_were
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} <= {f"_shard={s}" for s in range(3)}
    assert written.select("_shard", "_slot").distinct().count() == docs.count()
