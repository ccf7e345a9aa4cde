"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token files.

Each stage is a function of (spark, docs, sf_dir) that works on all that the stage before it kept.
``run`` writes what a stage returns and reads it back, so a stage is never worked out twice and
a lost machine costs no more than its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate, jaccard_join, mixing, quality, token_files
from tickloom.llm.columns import named
from tickloom.llm.queries import documents, tokenizer_file
from tickloom.llm.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle similarity links."""
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.keep_clean(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of all sources, as often as the target weights ask for."""
    return mixing.mix_sources(docs).select(*[named(c) for c in docs.columns])


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document is in the token files, and a checksum of its ids there."""
    return token_files.token_digest(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_output),
]

# Draws of the mix depend on hashes and seeded random numbers, and token ids on a vocabulary.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
