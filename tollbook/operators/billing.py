"""From rated events to monthly bills."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollbook.functions import fields
from tollbook.schemas import MONEY, SUMMARY_COLUMNS
from tollbook.tariff import DEFAULT_TERMS, SERVICES, BillingTerms


def service_pivot(rated: DataFrame, invoice_date: date | None = None) -> DataFrame:
    """Cost per subscriber, one column per service; NULL for a service not used."""
    per_service = [
        F.sum(F.when(F.col("record_type") == service, F.col("cost"))).alias(f"{service}_cost")
        for service in SERVICES
    ]
    stamp = F.lit(invoice_date) if invoice_date else F.current_date()
    return (
        rated.groupBy("user_identifier")
        .agg(*per_service, F.sum("cost").alias("total_cost"))
        .withColumn("invoice_date", stamp)
    )


USAGE_KEY = ("user_identifier", "billing_year", "billing_month", "record_type")
# Sums of the roll-up; each is the sum of the sums of any parts of the events.
USAGE_SUMS = ("total_duration_sec", "total_data_mb", "total_cost", "event_count")


def monthly_usage(rated: DataFrame, *per: str) -> DataFrame:
    """Usage and cost per subscriber, month and service, and per columns named in
    ``per``."""
    return rated.groupBy(
        "user_identifier",
        F.year("event_time").alias("billing_year"),
        F.month("event_time").alias("billing_month"),
        "record_type",
        *per,
    ).agg(
        F.sum("duration_sec").alias("total_duration_sec"),
        F.sum("data_volume_mb").alias("total_data_mb"),
        F.sum("cost").alias("total_cost"),
        F.count("*").alias("event_count"),
    )


def merged_usage(parts: DataFrame) -> DataFrame:
    """The roll-up of all events from those of parts of them, with its types."""
    kinds = dict(parts.dtypes)
    return parts.groupBy(*USAGE_KEY).agg(*[F.sum(name).cast(kinds[name]).alias(name) for name in USAGE_SUMS])


def apply_allowance(usage: DataFrame, terms: BillingTerms = DEFAULT_TERMS) -> DataFrame:
    """Voice is free within the allowance and charged per minute above it,
    whatever it was rated at; everything else keeps its cost."""
    allowance = terms.free_minutes * 60
    seconds = F.col("total_duration_sec")
    voice = F.col("record_type") == "voice"
    overage = (seconds - allowance) * F.lit(terms.overage_per_minute) / F.lit(60)
    return usage.withColumn(
        "adjusted_cost",
        F.when(voice & (seconds <= allowance), F.lit(0.0))
        .when(voice & (seconds > allowance), overage)
        .otherwise(F.col("total_cost").cast("double")),
    )


def apply_discounts(usage: DataFrame, terms: BillingTerms = DEFAULT_TERMS) -> DataFrame:
    reduced = F.col("adjusted_cost") * (1 - terms.loyalty_discount) - terms.fixed_promo
    if terms.floor_at_zero:
        reduced = F.greatest(reduced, F.lit(0.0))
    return usage.withColumn("discounted_cost", reduced)


def apply_tax(usage: DataFrame, terms: BillingTerms = DEFAULT_TERMS) -> DataFrame:
    """Tax, then money rounding: half away from zero, to two places."""
    taxed = F.round(F.col("discounted_cost") * (1 + terms.vat_rate), 2)
    return usage.withColumn("final_cost", taxed.try_cast(MONEY))


def bill_usage(usage: DataFrame, terms: BillingTerms = DEFAULT_TERMS) -> DataFrame:
    return apply_tax(apply_discounts(apply_allowance(usage, terms), terms), terms)


def bill(rated: DataFrame, terms: BillingTerms = DEFAULT_TERMS) -> DataFrame:
    return bill_usage(monthly_usage(rated), terms)


def summary(billed: DataFrame, *beside: str) -> DataFrame:
    """Bills under the column names of the billing summary."""
    return billed.withColumnsRenamed(
        {"user_identifier": "customer_id", "record_type": "service"}
    ).select(*SUMMARY_COLUMNS, *beside)


def _stamp(generated_at: datetime | None) -> Column:
    return F.lit(generated_at) if generated_at else F.current_timestamp()


def stamped(rows: DataFrame, generated_at: datetime | None = None) -> DataFrame:
    return rows.withColumn("generated_at", _stamp(generated_at))


def documents(rows: DataFrame) -> DataFrame:
    """The billing summary as the fields of an invoice document."""
    return rows.select(
        "customer_id",
        fields.period_label(F.col("billing_year"), F.col("billing_month")).alias("billing_period"),
        "service",
        F.col("event_count").alias("total_events"),
        F.col("final_cost").cast("double").alias("final_cost_MAD"),
        F.col("total_cost").cast("double").alias("original_cost"),
        "adjusted_cost",
        "discounted_cost",
    )
