"""The corpus pipeline: raw documents to token ids in training order.

Parquet files keep no order across readers, so the last stage restores it: the
files that it writes, by name, are in training order.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; all but the last return the columns of documents.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.llm.byte_bpe import byte_bpe
from recsift.llm.mixing import order_again, training_order
from recsift.llm.ngram_join import keep_one
from recsift.llm.pii import mask_pii
from recsift.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one(docs)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes a mark of its kind; ``n_chars`` follows the text."""
    masked = mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    return training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the text that they decode to, in training order."""
    coded = byte_bpe(order_again(docs), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("private_data", private_data),
    ("mixture", mixture),
    ("tokens", tokens),
]

# Expectation-maximisation and the tokenizer have no SQL form; tests/llm holds
# the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
