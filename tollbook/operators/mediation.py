"""From raw text to accepted and rejected usage records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.functions import fields, validity
from tollbook.schemas import CDR_COLUMNS, CLEAN_CDR, RAW_CDR


def parse_raw(values: DataFrame) -> DataFrame:
    """Raw records from a ``value`` column, which is kept as text in ``raw``.

    A wrongly typed field becomes NULL by itself; text that is no record at all
    becomes a row of NULLs.
    """
    text = F.col("value").cast("string")
    return values.select(
        text.alias("raw"), F.from_json(text, RAW_CDR, {"mode": "PERMISSIVE"}).alias("data")
    ).select("raw", "data.*")


def parse_clean(values: DataFrame) -> DataFrame:
    """Accepted records, as written by the clean sink."""
    text = F.col("value").cast("string")
    return values.select(F.from_json(text, CLEAN_CDR).alias("data")).select("data.*")


def type_event_time(records: DataFrame) -> DataFrame:
    return records.withColumn("timestamp", fields.event_time(F.col("timestamp")))


def flag_valid(
    records: DataFrame, per_service_technology: bool = False, keep_unknown: bool = False
) -> DataFrame:
    return records.withColumn("is_valid", validity.is_valid(per_service_technology, keep_unknown))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.col("is_valid")).drop("is_valid")


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_valid"))


def with_reasons(flagged: DataFrame, per_service_technology: bool = False) -> DataFrame:
    return flagged.withColumn("reject_reasons", validity.reject_reasons(per_service_technology))


def clean_records(flagged: DataFrame) -> DataFrame:
    """Accepted records with just the columns of the wire format."""
    return accepted(flagged).select(*CDR_COLUMNS)


def to_values(rows: DataFrame) -> DataFrame:
    """One JSON text per row, without its NULL fields."""
    return rows.select(F.to_json(F.struct("*")).alias("value"))


def mediate(values: DataFrame, per_service_technology: bool = False) -> DataFrame:
    """Raw text to flagged records: parse, type the event time, validate."""
    return flag_valid(type_event_time(parse_raw(values)), per_service_technology)
