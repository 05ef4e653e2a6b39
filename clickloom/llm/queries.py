"""The registered queries of the operators: each applies its operator, with production settings, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    ball_trees,
    chunk_reuse,
    conversation_repair,
    embedding_dedup,
    fingerprints,
    line_dedup,
    norm_buckets,
    packing,
    pseudonyms,
    quality,
    secrets,
    simhash,
    token_output,
)
from clickloom.llm.common import documents
from clickloom.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(documents(spark, sf_dir))


def op2_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The table has no repositories, so each distinct text is one; its source is the owner.
    found = secrets.find_secrets(documents(spark, sf_dir), repository=None)
    counts = F.transform("counts", lambda c: F.concat_ws(":", c["owners"], c["repositories"]))
    return found.withColumn("counts", F.array_join(counts, ","))


def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [f"n_{kind}" for kind in pseudonyms.PATTERNS]
    return pseudonyms.pseudonymise(documents(spark, sf_dir)).select("doc_id", "text", *counts)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(documents(spark, sf_dir), path))


def op5_embedding_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_simhash_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.packed_rows(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_reuse.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "text")
    field = quality.learn(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(rows, field).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.GOOD_FROM).cast("int").alias("predicted"),
    )


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.rank(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return conversation_repair.repair(rows)


def op13_ball_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return ball_trees.top_products(embeddings, query_every=SEARCHED_EVERY)


#: One vector in so many, by its id, is a query of the search.
SEARCHED_EVERY = 100

QUERIES: dict[str, Query] = {
    "op1_minhash_fingerprints": op1_minhash_fingerprints,
    "op2_secret_ownership": op2_secret_ownership,
    "op3_feistel_pseudonyms": op3_feistel_pseudonyms,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_embedding_tiles": op5_embedding_tiles,
    "op6_simhash_anchors": op6_simhash_anchors,
    "op7_line_dedup": op7_line_dedup,
    "op8_token_output": op8_token_output,
    "op9_bpe_chunk_reuse": op9_bpe_chunk_reuse,
    "op10_quality_crf": op10_quality_crf,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_ball_trees": op13_ball_trees,
}
