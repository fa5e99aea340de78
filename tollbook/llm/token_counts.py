"""Token counts through a cache keyed by content and tokenizer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm.common import lookup, text_of
from tollbook.llm.tokens import encoder
from tollbook.llm.words import read

CACHE = "tokenizer string, digest binary, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Names the file's content and the library's version: a count is only used for both."""
    with open(path, "rb") as content:
        return hashlib.sha256(content.read() + tokenizers.__version__.encode()).hexdigest()


def content_digest(text: Column) -> Column:
    """Of the UTF-8 bytes, null as empty; the tokenizer has no normaliser, so any
    stronger normalisation would change counts."""
    return F.unhex(F.sha2(F.encode(text, "UTF-8"), 256))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Digest and count, once each although two runs may have stored the same."""
    rows = spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def fill_cache(docs: DataFrame, tokenizer: str, cache: str) -> None:
    """Encode the distinct texts whose count is not stored and append their counts.

    One copy of each text is shuffled, by its digest and reduced before that, so
    a hot text is one row of each task. The append is one commit: a job that
    fails leaves nothing, and a repeated one stores only what is still missing.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    empty_cache(spark, cache)
    text = text_of("text")
    once = docs.select(content_digest(text).alias("digest"), text.alias("text"))
    once = once.groupBy("digest").agg(F.first("text").alias("text"))
    missing = once.join(read_cache(spark, cache, version), "digest", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoder(tokenizer)
        for digests, texts in read(batches):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([version] * len(texts), pa.string()),
                    pa.array(digests, pa.binary()),
                    pa.array([len(ids) for ids in of.encode(texts)], pa.int64()),
                ],
                names=["tokenizer", "digest", "n_tokens"],
            )

    missing.select("digest", "text").mapInArrow(run, CACHE).write.mode("append").parquet(cache)


def empty_cache(spark: SparkSession, cache: str) -> None:
    """Appending no rows creates a cache that is not there yet."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 1024) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document.

    Null texts count as empty (0 bytes, 0 tokens). Rows are kept as they are, so
    null or repeated ``doc_id`` and equal texts each give their row; other columns
    are ignored.
    """
    fill_cache(docs, tokenizer, cache)
    text = text_of("text")
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        content_digest(text).alias("digest"),
    )
    stored_counts = read_cache(docs.sparkSession, cache, tokenizer_digest(tokenizer))
    table = slim.groupBy("digest").agg(F.count("*").alias("rows")).join(stored_counts, "digest")
    return lookup(slim, table, ["digest"], "rows").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
