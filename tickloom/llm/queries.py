"""The registered queries of this subpackage and their SQL counterparts.

Each query applies an operator to the whole table it is meant for and derives the agreed columns
from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import (
    decontaminate,
    jaccard_join,
    lm_scoring,
    merkle,
    mixing,
    piece_codec,
    prefix_trie,
    quality,
    sharding,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
)
from tickloom.llm.scratch import written
from tickloom.llm.sql import ORACLES

Build = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Build] = {}

END_ID = 2


def query(build: Build) -> Build:
    QUERIES[build.__name__] = build
    return build


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def tokenizer_file() -> str:
    """The vocabulary that the queries use; operators take the file as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_model() -> str:
    """The SentencePiece model that the queries use; operators take the file as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), items)


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir))


@query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts before and after personal data is masked, a real edit of many documents with stored trees."""
    counted = token_counts.count_tokens(documents(spark, sf_dir), tokenizer_file())
    counted = written(counted, "token-counts")
    edited = counted.withColumn("edits", token_counts.masking_edits(F.col("text")))
    return token_counts.apply_edits(edited, tokenizer_file()).select(
        "doc_id", "tokens_before", "n_edits", "n_tokens", "encoded_chars"
    )


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digest(documents(spark, sf_dir), tokenizer_file())


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.strip_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.classes(documents(spark, sf_dir))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(documents(spark, sf_dir)).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.size("draws") * F.col("size")).alias("taken"),
    )


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = piece_codec.encode_documents(docs, piece_model()).select("doc_id", "ids")
    return piece_codec.decode_documents(coded, piece_model()).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir)).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root",
        "verified",
    )


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return prefix_trie.prefix_nodes(turns).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
