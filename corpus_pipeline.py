"""The corpus pipeline: quality, near-duplicates, benchmark leaks, mixing, token files.

Every stage takes all documents that the stage before it kept and returns the
columns of ``documents``; the last returns what it wrote, read back. Rows are
told apart by id and text, so repeated ids, null ids and extra columns are fine:
they pass through. An empty table stays empty.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontam, minhash, mixing, quality, tokenfile
from orderloom.llm.bpe import byte_bpe_path
from orderloom.llm.rows import KEY, attach, only, with_key, without
from orderloom.operators.storage import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base test or are probably bad by the weighed rules go."""
    keyed = with_key(docs)
    judged, _ = quality.judge(materialize(quality.text_counts(keyed, ("doc_id", KEY)), "counts"))
    rejected = materialize(judged.where(~F.col("kept")).select("doc_id", KEY).distinct(), "rejected")
    return without(keyed, rejected, ("doc_id", KEY)).drop(KEY)


NODE = "_near_id"


def _with_node(docs: DataFrame) -> DataFrame:
    """Add an id that tells texts apart: that of the row, or, where an id has several texts, one made
    of the id and the text's hash that sorts as the ids do. Null without an id."""
    keyed = with_key(docs)
    texts = keyed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(KEY).alias("a"), F.max(KEY).alias("b"))
    if texts.where("a != b").isEmpty():
        return keyed.withColumn(NODE, F.col("doc_id")).drop(KEY)
    place = F.col("doc_id").cast("string")
    if dict(docs.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint"):
        place = F.lpad((F.col("doc_id").cast("decimal(20,0)") + F.lit(Decimal(1 << 63))).cast("string"), 20, "0")
    return keyed.withColumn(NODE, F.concat(place, F.lit(":"), F.hex(KEY))).drop(KEY)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by 0.8 of five-word shingles the smallest id stays, once.

    Rows without an id stay, as nothing tells which of them a group should keep. Different texts
    under one id are different documents: each goes only for links of its own.
    """
    nodes = _with_node(docs)
    texts = nodes.select(F.col(NODE).alias("doc_id"), "text")
    found = materialize(minhash.near_duplicates(texts, minhash.Settings(words=5)), "near-duplicates")
    named = found.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", NODE)
    dropped = materialize(named.where(~F.col("kept")).select(NODE).distinct(), "dropped")
    kept = without(nodes, dropped, [NODE])
    repeated = named.where("kept").groupBy(NODE).count().where("count > 1")
    repeated = materialize(repeated.select(NODE), "repeated")
    if not repeated.isEmpty():
        once = only(kept, repeated, [NODE]).dropDuplicates([NODE])
        kept = without(kept, repeated, [NODE]).unionByName(once)
    return kept.drop(NODE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    keyed = with_key(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontam.find_items(keyed, benchmark, ("doc_id", KEY))
    hit = materialize(found.where(F.size("spans") > 0).select("doc_id", KEY).distinct(), "contaminated")
    return without(keyed, hit, ("doc_id", KEY)).drop(KEY)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix takes them, a last partial time counting as a whole one.

    Rows alike in id and text share what the mix takes of them. A text without words is not taken.
    """
    keyed = with_key(docs)
    _, totals = mixing.mix_sources(keyed, ("doc_id", KEY))
    summed = totals.groupBy("doc_id", KEY).agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    times = summed.where("taken > 0").select("doc_id", KEY, F.ceil(F.col("taken") / F.col("size")).alias("_times"))
    mixed = attach(keyed, materialize(times, "times"), ("doc_id", KEY))
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times")))
    return mixed.withColumn("_times", again).select(*[F.col(f"`{c}`") for c in docs.columns])


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; per document its place, length and checksum as read back."""
    return tokenfile.document_digests(tokenfile.write_token_files(docs, byte_bpe_path()))


STAGES = [
    ("quality", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_sources),
    ("token-files", token_files),
]

# Weighing rules by EM and writing token files have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
