"""The exact histogram of encoded lengths, and what it answers for every context limit.

Texts are encoded and counted by length; running sums from the longest length
down then tell, for every length L that occurs, how many texts and tokens have
at least L. From these follow the tokens left when texts are cut at L, and which
share of texts fits. Sums go by ranges of ``SPAN`` lengths first, so no task
orders more than one range or one row per range.

Defined cases: a null or empty text has length 0 plus the end id where one is
counted; repeated rows count as often as they occur; no texts, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.bpe import TEXT_BYTES, encoder, rest
from orderloom.llm.words import bytewise
from orderloom.operators.storage import materialize

SPAN = 1024


def _measuring(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in bytewise(batches, "_text", TEXT_BYTES):
            sizes = [len(ids) // 4 for ids in encoder(path).encode(batch.column("_text").to_pylist())]
            names = [n for n in batch.schema.names if n != "_text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sizes, pa.int64())], names=[*names, "n_tokens"])
        rest(path)

    return run


def encoded_lengths(docs: DataFrame, tokenizer: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep`` and ``n_tokens`` of each text under the vocabulary file ``tokenizer``."""
    texts = docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    own = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*keep).schema)
    return texts.mapInArrow(_measuring(tokenizer), own + "n_tokens bigint")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """Per length that occurs, from a column ``n_tokens``:

    ``n_docs`` of that length, ``docs_up_to`` and ``tokens_up_to`` (texts that fit whole and their
    tokens), ``docs_longer``, ``tokens_cut_at`` (all tokens left when every text is cut there) and
    ``share_up_to``, the quantile at which the length stands.
    """
    counts = lengths.where("n_tokens IS NOT NULL").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    # Both the sums over ranges and the rows come from the written counts: texts are encoded once.
    counts = materialize(counts.withColumn("range", F.expr(f"n_tokens div {SPAN}")), "length-counts")
    tokens = F.col("n_tokens") * F.col("n_docs")
    ranges = counts.groupBy("range").agg(F.sum("n_docs").alias("docs"), F.sum(tokens).alias("tokens"))
    longer = Window.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranges = ranges.select(
        "range",
        F.coalesce(F.sum("docs").over(longer), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("tokens").over(longer), F.lit(0)).alias("tokens_above"),
        F.sum("docs").over(everything).alias("all_docs"),
        F.sum("tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    joined = counts.join(ranges, "range").withColumns({
        "docs_longer": F.col("docs_above") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0)),
        "tokens_longer": F.col("tokens_above") + F.coalesce(F.sum(tokens).over(inside), F.lit(0)),
    })
    up_to, tokens_up_to = F.col("all_docs") - F.col("docs_longer"), F.col("all_tokens") - F.col("tokens_longer")
    return joined.select(
        "n_tokens",
        "n_docs",
        up_to.alias("docs_up_to"),
        tokens_up_to.alias("tokens_up_to"),
        "docs_longer",
        (tokens_up_to + F.col("docs_longer") * F.col("n_tokens")).alias("tokens_cut_at"),
        (up_to / F.col("all_docs")).alias("share_up_to"),
    )


def tokens_kept(histogram: DataFrame, limits: Sequence[int]) -> DataFrame:
    """For each of the given limits: ``tokens_kept`` when all texts are cut there, and ``docs_cut``."""
    columns = []
    for i, limit in enumerate(limits):
        fits = F.col("n_tokens") <= limit
        columns += [
            F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("n_docs")).alias(f"kept_{i}"),
            F.sum(F.when(~fits, F.col("n_docs")).otherwise(0)).alias(f"cut_{i}"),
        ]
    rows = [F.struct(F.lit(x).cast("bigint").alias("limit"), F.coalesce(f"kept_{i}", F.lit(0)).alias("tokens_kept"),
                     F.coalesce(f"cut_{i}", F.lit(0)).alias("docs_cut")) for i, x in enumerate(limits)]
    return histogram.agg(*columns).select(F.inline(F.array(*rows)))


def quantile(histogram: DataFrame, share: float | Column) -> DataFrame:
    """``n_tokens``: the smallest length up to which at least ``share`` of the texts go; no texts, null."""
    enough = F.col("share_up_to") >= share
    return histogram.agg(F.min(F.when(enough, F.col("n_tokens"))).alias("n_tokens"))
