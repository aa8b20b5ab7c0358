"""The corpus operators as registered queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    clusters,
    decontam,
    html,
    lengths,
    lm,
    minhash,
    mixing,
    pseudonyms,
    quality,
    sharding,
    tokenfile,
    warc,
    whitening,
)
from orderloom.llm.bpe import byte_bpe_path
from orderloom.llm.oracles import ORACLES
from orderloom.operators.storage import materialize

__all__ = ["ORACLES", "QUERIES"]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = materialize(quality.text_counts(_read(spark, sf_dir, "documents")), "counts")
    judged, _ = quality.judge(counts)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good"
    )


# A public key for tests and examples; a real one comes from a secret store.
EXAMPLE_KEY = "example key"


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(_read(spark, sf_dir, "documents"), EXAMPLE_KEY)


def op5_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.length_histogram(lengths.encoded_lengths(_read(spark, sf_dir, "documents"), byte_bpe_path(), ()))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(_read(spark, sf_dir, "pages"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_read(spark, sf_dir, "documents"), minhash.Settings(words=2))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    hit = decontam.hit_words(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    model = lm.train(docs.where(~lm.held_out(F.col("doc_id"))))
    return lm.score(docs, model).select(
        "doc_id",
        lm.held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, totals = mixing.mix_sources(_read(spark, sf_dir, "documents"))
    return totals


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(_read(spark, sf_dir, "pages"))
    return warc.page_digests(warc.read_chunks(spark, archives))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenfile.write_token_files(_read(spark, sf_dir, "documents"), byte_bpe_path())
    return tokenfile.document_digests(files)


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_read(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = clusters.cluster(_read(spark, sf_dir, "embeddings"))
    sums = clusters.cluster_sums(assigned)
    numbers = range(max(1, len(centroids)))
    inertias = F.array(*[F.lit(sums.get(i, 0)).cast("bigint") for i in numbers])
    digests = F.array(*[F.lit(clusters.centroid_digest(centroids[i]) if centroids else "") for i in numbers])
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        inertias[F.col("cluster")].alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("bigint").alias("inertia"),
        digests[F.col("cluster")].alias("centroid_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, distinct, fit = whitening.whiten(_read(spark, sf_dir, "embeddings"))
    shares = [] if fit is None else (fit.values / fit.trace).tolist()
    explained = F.array(*[F.lit(share) for share in shares or [0.0]])
    return rows.select(
        "vec_id",
        "component",
        F.lit(0 if fit is None else fit.rows).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        explained[F.col("component") - 1].alias("explained"),
        F.lit(0.0 if fit is None else whitening.identity_error(distinct, fit)).alias("identity_error"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc": op2_warc,
    "op3_token_files": op3_token_files,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_length_histogram": op5_length_histogram,
    "op6_html_text": op6_html_text,
    "op7_minhash": op7_minhash,
    "op8_decontamination": op8_decontamination,
    "op9_lm_score": op9_lm_score,
    "op10_mix_sources": op10_mix_sources,
    "op11_shards": op11_shards,
    "op12_clusters": op12_clusters,
    "op13_whitening": op13_whitening,
}
