from __future__ import annotations

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.llm import quality
from tests.llm.samples import clashing, documents, nothing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, x in enumerate(zip(words, words[1:], words[2:])) if windows[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


@pytest.mark.parametrize("table", [documents, clashing])
def test_counts_and_base_test(spark, table):
    docs = table(spark)
    judged, _ = quality.judge(quality.text_counts(docs, ("doc_id", "text")))
    rows = judged.collect()
    assert len(rows) == docs.count()
    for row in rows:
        n, chars, symbols, lines, repeated = counted(row.text)
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (n, chars, symbols, lines, repeated)
        assert row.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (row.base_failed and row.kept)


def test_empty_table_gives_the_prior(spark):
    judged, model = quality.judge(quality.text_counts(nothing(spark)))
    assert judged.count() == 0
    assert model.shares[0] == pytest.approx(quality.GOOD_SHARE)


def test_em_finds_rates_of_a_planted_model(spark):
    """Good texts get 1 % wrong votes; each fault trips its rule nine times in ten and others rarely."""
    rules = ["r0", "r1", "r2"]
    bad_rate = F.when(F.col("z") == 0, 0.01)
    votes = []
    for r in range(3):
        rate = bad_rate.when(F.col("z") == r + 1, 0.9).otherwise(0.05)
        votes.append(F.when(F.rand(r) < 0.2, 0).when(F.rand(10 + r) < rate, -1).otherwise(1).alias(f"r{r}"))
    kind = F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 10 - 6)
    voted = spark.range(20_000).withColumn("z", kind).select("z", *votes).cache()
    model = quality.fit_votes(voted, rules)
    for r in range(3):
        assert model.bad[r][r + 1] == pytest.approx(0.9, abs=0.06)
        assert model.bad[r][0] < 0.02
    judged = model.add_posterior(voted).withColumn("right", (F.col("p_good") >= 0.5) == (F.col("z") == 0))
    assert judged.agg(F.avg(F.col("right").cast("int"))).first()[0] > 0.9


def test_verdicts_agree_with_labels(spark):
    sf = "/root/testdata/sf0.01"
    judged, _ = quality.judge(quality.text_counts(spark.read.parquet(f"{sf}/documents.parquet")))
    both = judged.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where(~F.col("base_failed"))
    right = F.avg((F.col("kept") == (F.col("quality") == 1)).cast("int"))
    assert both.agg(right).first()[0] > 0.97
