"""The corpus pipeline: quality rules, near-duplicates, mixing to target weights, token ids.

Each stage reads what its predecessor kept; between stages the rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoloom.llm import bpe, jaccard, mixing, quality, simhash
from chronoloom.llm.common import materialize, once, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.judge(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return simhash.keep_one(docs.select(*COLUMNS), find=jaccard.groups)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A whole document for each time that the mix takes of it, shuffled in shards: a source's words exceed its target by
    less than its last document in each epoch."""
    sized = once(docs.select(*COLUMNS), size=F.size(words(F.col("text"))).cast("bigint"))
    return mixing.in_shards(mixing.mix(sized), COLUMNS).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, their number, and digests of them and of the bytes that they decode to."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality_rules", quality_rules), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("byte_bpe", byte_bpe)]

#: The stages draw by seeded hashes and merge by rank, which SQL cannot express; tests/llm/test_pipeline.py holds run()
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = materialize(docs, name)
    return docs
