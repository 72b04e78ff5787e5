"""The operators' registered queries ``opN_<name>`` and their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, lm, merkle, packing, quality, secrets, simhash, substring, topk, toxicity, urls, vector_codes
from .queries_sql import OP8_SQL, OP11_SQL, op12_sql, op13_sql

BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
PACK_TOKENIZER = "byte_bpe_50k.json"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.simhash_dedup(_documents(spark, sf_dir), shingle=3, distance=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.lm_scores(_documents(spark, sf_dir))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN
    out = bpe.round_trip(_documents(spark, sf_dir), path, pattern)
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256")
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.secrets(_documents(spark, sf_dir))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_documents(spark, sf_dir), public_tokenizers.path(PACK_TOKENIZER), public_tokenizers.PATTERN)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(_documents(spark, sf_dir))
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.quality(_documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "odd_share")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(_documents(spark, sf_dir))


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(_embeddings(spark, sf_dir), lambda vec_id: vec_id % 50 == 0, k=5)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    received = {"text": F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))}
    out = merkle.merkle_manifest(_documents(spark, sf_dir), received=received, proofs=False)
    return out.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.vector_codes(_embeddings(spark, sf_dir), parts=16, entries=64, rounds=2)
    return coded.select("vec_id", "code", "error", "label_error", F.lit(vector_codes.book_digest(books)).alias("codebooks_sha256"))


def queries() -> dict:
    found = [op1_simhash_dedup, op2_lm_scoring, op3_byte_bpe, op4_toxicity, op5_url_filter, op6_secret_scan, op7_best_fit_packing, op8_exact_dedup, op9_quality_rules, op10_substring_dedup, op11_exact_top_k, op12_merkle_manifest, op13_vector_codes]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict:
    return {"op8_exact_dedup": OP8_SQL, "op11_exact_top_k": OP11_SQL, "op12_merkle_manifest": op12_sql(), "op13_vector_codes": op13_sql()}
