"""Cost of one event. Decimal arithmetic throughout, so sums do not depend on order."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tollbook.schemas import COST
from tollbook.tariff import DEFAULT_TARIFF, Tariff

# units * price is decimal(33,18): always representable, rounded once at the end.
UNITS = T.DecimalType(20, 10)
PRICE = T.DecimalType(12, 8)


def price_literal(value: Decimal) -> Column:
    return F.lit(value).cast(PRICE)


def is_peak(time: Column, tariff: Tariff = DEFAULT_TARIFF) -> Column:
    hour = F.hour(time)
    return reduce(or_, [hour.between(first, last) for first, last in tariff.peak_hours])


def units() -> Column:
    """Seconds, messages or megabytes; NULL if the service has no tariff."""
    service = F.col("record_type")
    return (
        F.when(service == "voice", F.col("duration_sec").cast(UNITS))
        .when(service == "sms", F.lit(1).cast(UNITS))
        .when(service == "data", F.col("data_volume_mb").try_cast(UNITS))
    )


def is_billable() -> Column:
    """Whether there is something to charge. Tested on the stored values: a
    volume too large for ``units`` is billable and ends as a NULL cost."""
    service = F.col("record_type")
    return (
        F.when(service == "voice", F.col("duration_sec") > 0)
        .when(service == "sms", F.lit(True))
        .when(service == "data", F.col("data_volume_mb") > 0)
    )


def above_threshold(tariff: Tariff = DEFAULT_TARIFF) -> Column:
    return F.col("data_volume_mb") > F.lit(float(tariff.volume_threshold_mb))


def voice_price(tariff: Tariff = DEFAULT_TARIFF) -> Column:
    return F.when(is_peak(F.col("event_time"), tariff), price_literal(tariff.voice_peak_rate)).otherwise(
        price_literal(tariff.voice_rate)
    )


def data_price(tariff: Tariff = DEFAULT_TARIFF) -> Column:
    """Price per megabyte by technology, NULL for a technology without a rate.

    Above the threshold the discount covers the whole volume.
    """

    def card(factor: Decimal) -> Column:
        entries = [(F.lit(t), price_literal(r * factor)) for t, r in tariff.data_rates.items()]
        return F.create_map(*[column for entry in entries for column in entry])

    technology = F.col("technology")
    return F.when(
        above_threshold(tariff), card(1 - tariff.volume_discount)[technology]
    ).otherwise(card(Decimal(1))[technology])


def unit_price(tariff: Tariff = DEFAULT_TARIFF) -> Column:
    service = F.col("record_type")
    return (
        F.when(service == "voice", voice_price(tariff))
        .when(service == "sms", price_literal(tariff.sms_price))
        .when(service == "data", data_price(tariff))
    )


def charge(price: Column) -> Column:
    """Units times price; 0 if there is nothing to charge; NULL if there is no
    price or the amount does not fit the cost column."""
    return F.when(is_billable(), (units() * price).try_cast(COST)).otherwise(F.lit(0).cast(COST))


def cost(tariff: Tariff = DEFAULT_TARIFF) -> Column:
    return charge(unit_price(tariff))


def rating_status(price: Column) -> Column:
    """Rated if something is charged before the amount is rounded to the cost
    column: a very small volume costs 0.0000 and still counts as billed."""
    charged = F.col("cost").isNotNull() & is_billable() & (units() * price > 0)
    return F.when(charged, F.lit("rated")).otherwise(F.lit("unrated"))
