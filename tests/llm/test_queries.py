"""The registered corpus queries against their SQL, and the pipeline against its stages done by hand."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from orderloom.llm import mixing, quality
from orderloom.llm.bpe import byte_bpe_path
from orderloom.llm.queries import ORACLES, QUERIES
from tests.compare import connect, difference
from tests.llm.samples import DOCS, documents, nothing
from tests.llm.test_decontam import expected as leaked
from tests.llm.test_minhash import brute

SF_DIR = "/root/testdata/sf0.001"
NATIVE = ("op4_pseudonyms", "op10_mix_sources", "op11_shards")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", QUERIES)
def test_one_row_per_document_or_page(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    table = {"page_id": "pages", "vec_id": "embeddings"}.get(found.columns[0], "documents")
    if name != "op5_length_histogram":
        times = 4 if name == "op13_whitening" else 1
        assert found.count() == times * spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if name in NATIVE:
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def by_hand(spark, docs, benchmark):
    """The rows that the first three stages keep."""
    judged, _ = quality.judge(quality.text_counts(docs, ("doc_id", "text")))
    kept = judged.where("kept").select("doc_id", "text").collect()
    root = brute(kept, 5)
    kept = [r for r in kept if r.doc_id is None or root[r.doc_id] == r.doc_id]
    return [r for r in kept if not leaked(r.text, benchmark)[1]]


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    kept = by_hand(spark, docs, benchmark)
    ids = [r.doc_id for r in kept]
    _, totals = mixing.mix_sources(docs.where(F.col("doc_id").isin(ids)))
    times = {r.doc_id: -(-r.taken // r.size) for r in totals.collect()}
    library = tokenizers.Tokenizer.from_file(byte_bpe_path())
    expected, start = [], 0
    for r in sorted(kept, key=lambda r: r.doc_id):
        tokens = [*library.encode(r.text, add_special_tokens=False).ids, 0]
        for _ in range(times[r.doc_id]):
            expected.append((r.doc_id, start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
            start += len(tokens)
    found = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert found == sorted(expected) and len(found) > 50


@pytest.mark.parametrize("table", [documents, nothing])
def test_stages_take_awkward_rows(spark, table):
    docs = table(spark).withColumns({"kept": F.lit(1), "taken": F.lit("x"), "size": F.lit(None).cast("int")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == [*[x.split()[0] for x in DOCS.split(", ")], "kept", "taken", "size"]
        assert name == "mixing" or docs.count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.count() == docs.count()


def test_repeated_ids_stay_once(spark):
    text = " ".join(f"v{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text), (3, text + " other words"), (4, text[::-1])], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()) == [1, 4]


def test_different_texts_under_one_id_stay(spark):
    """Each text goes only for a link of its own; rows without an id all stay."""
    a, b, c, d = (" ".join(f"{letter}{i}" for i in range(60)) for letter in "abcd")
    rows = [(1, a), (2, a + " more"), (2, b), (3, c), (3, d), (-4, c), (5, b), (5, b), (None, a), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()]
    expected = [(1, a), (2, b), (3, d), (-4, c), (None, a), (None, a)]
    assert sorted(kept, key=repr) == sorted(expected, key=repr)
