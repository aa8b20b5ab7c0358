from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orderloom.llm import lm
from orderloom.operators import storage
from tests.llm.samples import clashing, documents, nothing


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


@pytest.mark.parametrize("table, shard", [(documents, lm.SHARD_BYTES), (documents, 40_000), (clashing, lm.SHARD_BYTES)])
def test_scores_against_exact_counts(spark, table, shard):
    docs = table(spark)
    rows = docs.withColumn("out", lm.held_out(F.col("doc_id"))).collect()
    assert all(r.out == (zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 7 == 2) for r in rows)
    single, pair = Counter(), Counter()
    for r in rows:
        if not r.out:
            single.update(tokens(r.text))
            pair.update(zip([0, *tokens(r.text)], tokens(r.text)))
    total, distinct = sum(single.values()), len(single)
    model = lm.train(docs.where(~lm.held_out(F.col("doc_id"))), shard_bytes=shard)
    assert (model.train_tokens, model.distinct) == (total, distinct)
    assert (model.shards > 1) == (shard < 100_000)
    found = lm.score(docs, model, ("doc_id", "text")).collect()
    assert len(found) == len(rows)
    begins = single[None]
    for r in found:
        own = tokens(r.text)
        p1 = [(single[t] + 1) / (total + distinct + 1) for t in own]
        assert (r.n_tokens, r.n_known) == (len(own), sum(single[t] > 0 for t in own))
        assert r.base_score == pytest.approx(sum(map(math.log10, p1)), abs=1e-6)
        exact = 0.0
        for u, w, p in zip([0, *own], own, p1):
            before = begins if u == 0 else single[u]
            n = pair[u, w]
            low = min(2 ** int(math.log2(n)) if n else 0, single[w], before)
            exact += math.log10((low + model.prior * p) / (before + model.prior))
        assert exact - 1e-6 <= r.score <= exact + 0.05 * len(own) + 1  # chance hits only raise it, and rarely


def test_unseen_pairs_seldom_pass_as_seen(spark):
    """Nearly all pairs are distinct, so there are as many events as tokens."""
    words = np.random.default_rng(3).integers(0, 20_000, (200, 2500))
    texts = [(" ".join(f"w{w}" for w in row),) for row in words]
    model = lm.train(spark.createDataFrame(texts, "text string"))
    unseen = np.random.default_rng(4).integers(0, 1 << 63, 200_000, dtype=np.uint64)
    shards = [lm.Shard.mapped(model.write_shard(k)) for k in range(model.shards)]
    passed = sum(shard.levels(unseen, model.segments) > 0 for shard in shards)
    assert 0 < passed.mean() < 0.027


def test_nothing_to_learn_from(spark):
    model = lm.train(nothing(spark))
    rows = lm.score(documents(spark), model).collect()
    assert rows and all(r.base_score == 0 and r.score == 0 and r.n_known == 0 for r in rows)
    assert lm.score(nothing(spark), model).count() == 0


def test_pairs_help_on_texts_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = lm.held_out(F.col("doc_id"))
    model = lm.train(docs.where(~held))
    sums = lm.score(docs.where(held), model).agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > sums[1]


def test_many_shards_write_nothing_but_the_shards(spark, tmp_path, monkeypatch):
    def written():
        return {f for f in tmp_path.rglob("*") if f.is_file()}

    monkeypatch.setattr(storage, "shared_folder", lambda spark: str(tmp_path))
    docs = documents(spark)
    model = lm.train(docs, shard_bytes=20_000)
    assert model.shards > 2
    before = written()
    many = lm.score(docs, model).collect()
    new = written() - before
    assert len(new) == model.shards and all(f.name.startswith("shard-") for f in new)
    assert Counter(many) == Counter(lm.score(docs, lm.train(docs)).collect())


@pytest.mark.parametrize("segments", [1, 3, 16, 1000, 1 << 20])
def test_pairs_placed_by_segment_are_found_again(segments):
    pairs = np.r_[np.random.default_rng(5).integers(0, 1 << 64, 10_000, dtype=np.uint64), np.uint64(0), np.uint64(2**64 - 1)]
    placed = np.sort(lm._placed(pairs, segments))
    found, line = lm._found_at(placed, 0, segments, segments)
    assert np.array_equal(np.sort(found), np.sort(pairs))
    assert np.array_equal(line, lm._segment(found, segments)) and (np.diff(line) >= 0).all()


def test_groups_of_segments_in_shards_of_another_size(spark):
    words = np.random.default_rng(6).zipf(1.3, (480, 2500)) % 30_000
    texts = [" ".join(f"w{w}" for w in row) for row in words]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string").repartition(4)
    model = lm.train(docs, shard_bytes=400_000)
    assert model.segments > lm.GROUPED and model.shards > 2 and model.each % lm.GROUPED
    packed = lm.packed_pairs(docs, model.segments).agg(F.sum(F.length("packed")), F.sum("n"), F.count("*")).first()
    assert packed[0] < 8 * packed[1] and packed[2] == 4 * len(model.filter)  # 24 bytes a pair in a row for each before
    tokens, before, _ = lm.tokens_of(pa.array(texts))
    pairs, counts = np.unique(lm.pairs_of(before, tokens), return_counts=True)
    shards = [lm.Shard.mapped(model.write_shard(k)) for k in range(model.shards)]
    levels = sum(shard.levels(pairs, model.segments) for shard in shards)
    least = 1 + np.floor(np.log2(counts))
    assert (levels >= least).all() and (levels == least).mean() > 0.97
    assert Counter(lm.score(docs, model).collect()) == Counter(lm.score(docs, lm.train(docs)).collect())


def test_files_of_other_stores_are_copied_to_the_nodes(spark, monkeypatch):
    docs = documents(spark)
    model = lm.train(docs, shard_bytes=40_000)
    mapped = Counter(lm.score(docs, model).collect())
    monkeypatch.setattr(lm, "mounted_path", lambda path: None)
    assert Counter(lm.score(docs, model).collect()) == mapped
