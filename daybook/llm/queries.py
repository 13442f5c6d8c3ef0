"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.llm import (
    bpe,
    centroids,
    embeddings,
    level_packing,
    lines,
    minhash,
    packing,
    periodic,
    quality,
    secrets,
    sharding,
    substrings,
    toxicity,
)
from daybook.llm.common import WORD, ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = substrings.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def embedding_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def minhash_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), ranks)


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = lines.remove_lines(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"))


def _with_planted_run(docs: DataFrame) -> DataFrame:
    """The contract's input: every tenth document, by the CRC of its id, goes on periodically from some word."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic_from(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        numbers = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        return F.array_join(F.transform(numbers, lambda k: F.get(words, k.cast("int"))), " ")

    # The one-element array names the words, so that the text is split once.
    words = F.array(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    text = F.transform(words, lambda w: F.when(F.size(w) > 0, periodic_from(w)).otherwise(""))[0]
    return docs.select("doc_id", F.when(h % 10 == 0, text).otherwise(F.col("text")).alias("text"))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(_with_planted_run(_table(spark, sf_dir, "documents")))
    # Greatest length first, then smallest start and period; null without a run.
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    found = found.withColumn("best", best)
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf_dir, "embeddings")).drop("centroid")


def level_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = level_packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": substring_dedup,
    "op2_toxicity": toxic_documents,
    "op3_embedding_dedup": embedding_near_dups,
    "op4_minhash_dedup": minhash_near_dups,
    "op5_best_fit_packing": best_fit_packing,
    "op6_quality_rules": quality_rules,
    "op7_byte_bpe": byte_bpe,
    "op8_secret_scan": secret_scan,
    "op9_line_dedup": line_dedup,
    "op10_hilbert_sharding": hilbert_shards,
    "op11_periodic_runs": periodic_runs,
    "op12_centroid_clusters": centroid_clusters,
    "op13_level_packing": level_windows,
}
