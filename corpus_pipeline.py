"""From raw documents to token ids: one stage per operator, each over what the one before kept.

Every stage takes and returns whole rows of `documents`, extra columns included; the last
returns doc_id, n_tokens, ids and the sha256 of the text decoded from them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart.llm.block_naming import exact_dedup
from flowmart.llm.bpe import token_round_trip
from flowmart.llm.contamination import decontaminated
from flowmart.llm.near_duplicates import near_dedup
from flowmart.llm.rank_profiles import in_a_language
from flowmart.session import pin

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those as far from every language's profile as can be."""
    return in_a_language(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that with the largest doc_id."""
    return exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, similarity 0.8 or more."""
    return near_dedup(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover a twentieth of the words go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids as little-endian unsigned 32-bit integers, and what they decode to."""
    made = token_round_trip(docs, TOKENIZER)
    return made.select(
        "doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenize),
]

#: SQL cannot express the stages' sketches and tokens; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
