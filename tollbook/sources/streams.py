"""Streams of records, as a ``value`` column whatever the transport."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream_path(path: str) -> str:
    """A pattern matching just ``path``: a file stream then accepts a single
    file as well as a folder of files."""
    bare = path.rstrip("/")
    return f"{bare[:-1]}[{bare[-1]}]"


def text_stream(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    ignore_missing_files: bool = False,
) -> DataFrame:
    """One record per line of the files arriving below ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if ignore_missing_files:
        reader = reader.option("ignoreMissingFiles", "true")
    return reader.load(path).select("value")


def topic_options(
    servers: str,
    topic: str,
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options to read a topic from its beginning."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def topic_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Records of a topic; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )
