"""Registered queries of the thirteen operators, with production parameters, each
over its whole table, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.llm import sql
from recsift.llm.alignment import align_tokens
from recsift.llm.byte_bpe import byte_bpe
from recsift.llm.contamination import contamination
from recsift.llm.ego_join import near_vectors
from recsift.llm.merkle import merkle_proofs
from recsift.llm.mixing import mix_sources, sorted_by_position, training_positions
from recsift.llm.ngram_join import jaccard_join
from recsift.llm.pii import KINDS, find_pii
from recsift.llm.quality import score_quality
from recsift.llm.sharding import hilbert_shards
from recsift.llm.substring_dedup import substring_dedup
from recsift.llm.token_counts import token_counts
from recsift.llm.warc import new_folder, read_records, write_archives


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(_documents(spark, sf_dir))
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("pii_spans", lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("pii_spans", text), ",").alias("spans"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_ego_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                     public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    folder = new_folder(pages)
    records = read_records(write_archives(pages, folder), folder)
    # of a response, length and digest are taken from the payload that was read
    read = F.col("payload").isNotNull()
    return records.select(
        "page_id", F.when(read, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(read, F.sha2("payload", 256)).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_documents(spark, sf_dir))
    mixed = mixed.select("doc_id", "size", "source_size", "target", "taken",
                         F.try_element_at("positions", F.lit(1)).alias("first_position"),
                         F.try_element_at("positions", F.lit(-1)).alias("last_position"))
    return sorted_by_position(mixed, F.col("first_position"), F.xxhash64("doc_id"))


def op7_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_positions(_documents(spark, sf_dir))


def op8_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(_documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_proofs(_documents(spark, sf_dir))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in globals().items() if name.startswith("op")}

# The others have none: SQL here has no tokenizer, checksum, expectation-
# maximisation or transducers.
ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": sql.SUBSTRING_DEDUP,
    "op3_ego_join": sql.EGO_JOIN,
    "op5_warc": sql.WARC,
    "op7_mixing": sql.MIXING,
    "op7_positions": sql.POSITIONS,
    "op9_ngram_join": sql.NGRAM_JOIN,
    "op11_merkle": sql.MERKLE,
    "op12_decontamination": sql.CONTAMINATION,
}
