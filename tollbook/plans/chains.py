"""The operator chains the jobs and queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tollbook.operators import billing, dedup, mediation, rating
from tollbook.tariff import DEFAULT_TARIFF, DEFAULT_TERMS, BillingTerms, Tariff


def unique_records(records: DataFrame) -> DataFrame:
    """Typed records to accepted records, each once."""
    clean = mediation.clean_records(mediation.flag_valid(records))
    return dedup.deduplicate(clean, dedup.SUBSCRIBER_KEY)


def unique_usage(records: DataFrame) -> DataFrame:
    """The same, reduced to the columns pricing needs before anything is
    shuffled. Prices follow from those columns, so they are added afterwards."""
    usage = rating.to_usage(mediation.accepted(mediation.flag_valid(records)))
    return dedup.deduplicate(usage, dedup.USAGE_KEY)


def priced_events(records: DataFrame, tariff: Tariff = DEFAULT_TARIFF) -> DataFrame:
    return rating.price(unique_usage(records), tariff)


def rated_events(records: DataFrame, tariff: Tariff = DEFAULT_TARIFF) -> DataFrame:
    """Typed records to the rows of the rated-events table."""
    return rating.sanitize(priced_events(records, tariff))


def billing_summary(
    records: DataFrame,
    tariff: Tariff = DEFAULT_TARIFF,
    terms: BillingTerms = DEFAULT_TERMS,
) -> DataFrame:
    """Typed records to the billing summary."""
    events = rating.rated_only(rated_events(records, tariff))
    return billing.summary(billing.bill(events, terms))
