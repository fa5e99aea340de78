"""Invoice headers and their line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tollbook.functions import fields
from tollbook.operators.joins import balanced_join


def invoice_headers(rated: DataFrame) -> DataFrame:
    """One unpaid invoice per subscriber and month."""
    start = fields.period_start(F.col("event_time"))
    totals = rated.groupBy(
        F.col("user_identifier").alias("user_id"), start.alias("billing_period_start")
    ).agg(F.sum("cost").alias("total_cost"))
    return totals.select(
        fields.invoice_key(F.col("user_id"), F.col("billing_period_start")).alias("invoice_id"),
        "user_id",
        "billing_period_start",
        F.last_day("billing_period_start").alias("billing_period_end"),
        "total_cost",
        F.lit(False).alias("paid"),
    )


def line_items(rated: DataFrame) -> DataFrame:
    """(invoice, event) pairs. The invoice key follows from the event itself,
    so this needs neither join nor shuffle."""
    start = fields.period_start(F.col("event_time"))
    return rated.select(
        fields.invoice_key(F.col("user_identifier"), start).alias("invoice_id"), "event_id"
    )


def line_items_of(invoices: DataFrame, rated: DataFrame) -> DataFrame:
    """(invoice, event) pairs for invoices that carry keys of another origin.

    An equi-join on subscriber and month, balanced because one subscriber may
    own a large part of all events.
    """
    events = rated.select(
        "event_id",
        F.col("user_identifier").alias("user_id"),
        fields.period_start(F.col("event_time")).alias("billing_period_start"),
    )
    keys = ["user_id", "billing_period_start"]
    headers = invoices.select("invoice_id", *keys)
    joined = balanced_join(events, headers, keys, F.col("event_id"))
    return joined.select("invoice_id", "event_id")
