"""From raw documents to packed sequences: each stage calls one operator and works on
all documents that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.llm import ngram_join, packing, quality_model, quality_rules, substring_dedup
from tollbook.llm.common import reachable, stored, with_row

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def numbered(docs: DataFrame) -> DataFrame:
    """``_row``, unique even where ``doc_id`` is null or repeats, the text, and all of
    the document in ``doc``, where no name can clash."""
    reachable(docs.sparkSession)
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("doc")
    return with_row(docs, "doc_id", F.col("text").cast("string").alias("text"), whole).drop("doc_id")


def texts(rows: DataFrame) -> DataFrame:
    """What the operators get: the row's number as ``doc_id``, so that verdicts name rows."""
    return rows.select(F.col("_row").alias("doc_id"), "text")


def only(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents among the verdicts, in their own columns."""
    return rows.join(verdicts.select(F.col("doc_id").alias("_row")), "_row", "left_semi").select("doc.*")


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base accepts and the weighed rules hold for good."""
    rows = numbered(docs)
    return only(rows, quality_rules.judge(texts(rows), "doc_id").filter("kept"))


def quality_model_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer finds of good form and without abuse."""
    rows = numbered(docs)
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return only(rows, quality_model.score(texts(rows), model).filter("kept"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest number."""
    rows = numbered(docs)
    return only(rows, ngram_join.near_duplicates(texts(rows)).filter("first"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that occur again; the words left are joined by
    spaces, and a text that loses nothing stays as it is."""
    rows = numbered(docs)
    shorter = substring_dedup.remove_repeats(texts(rows), untouched=True)
    shorter = shorter.select(F.col("doc_id").alias("_row"), "kept_text")
    rest = [c for c in docs.columns if c != "text"]
    slim = rows.select("_row", F.struct(*[F.col(f"doc.`{c}`") for c in rest], F.col("text").isNull().alias("no text")).alias("doc"))
    both = slim.join(shorter, "_row")
    text = F.when(~F.col("doc.no text"), F.col("kept_text"))
    kinds = dict(docs.dtypes)
    new = {"text": text, "n_chars": F.when(text.isNotNull(), F.length(text)).otherwise(F.col("doc.n_chars")) if "n_chars" in rest else None}
    return both.select(
        *[(new[c].cast(kinds[c]) if new.get(c) is not None else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns]
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    reachable(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rule_stage),
    ("quality classifier", quality_model_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("packing", packing_stage),
]

#: The scorer is fitted step by step, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = reachable(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
