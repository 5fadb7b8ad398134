"""The corpus pipeline: filter, deduplicate, mask secrets, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and read again as the next stage's docs. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import exact, jaccard, packing, quality, secret_scan
from tributary.llm.common import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Word shingles, overlap and packing cannot be said in one SQL statement that
# fixes the sequences; a test compares the run with a brute-force version.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents no quality rule rejects."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact.deduplicate(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secret values masked and their lengths brought up to date."""
    return secret_scan.mask_secrets(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
