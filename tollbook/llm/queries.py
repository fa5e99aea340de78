"""The queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm import (
    bpe,
    id_files,
    ngram_join,
    packing,
    prefix_trie,
    quality_model,
    quality_rules,
    substring_dedup,
    token_counts,
    tree_bpe,
    turn_repair,
    vector_join,
    warc,
)
from tollbook.llm.common import reachable, work_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return reachable(spark).read.parquet(f"{folder}/{name}.parquet")


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op3_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, folder, "documents"), "doc_id")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior"
    )


@query
def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = work_folder(spark, "warc")
    manifest = warc.write_archives(table(spark, folder, "pages"), archives)
    return warc.read_archives(manifest, archives, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op6_quality_model(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_model.score(docs, quality_model.train(docs, table(spark, folder, "labels")))


@query
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, folder, "documents"), tokenizer, work_folder(spark, "token-cache"))


@query
def op8_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op9_id_files(spark: SparkSession, folder: str) -> DataFrame:
    shards = work_folder(spark, "ids")
    manifest = id_files.write_shards(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), shards)
    return id_files.read_documents(manifest, shards)


@query
def op10_vector_join(spark: SparkSession, folder: str) -> DataFrame:
    return vector_join.near_vectors(table(spark, folder, "embeddings"))


@query
def op12_tree_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return tree_bpe.digests(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op11_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_conversations(table(spark, folder, "conversations"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, folder, "conversations"))
