"""From accepted records to priced events."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.functions import fields, pricing
from tollbook.operators.joins import BROADCAST_ROWS, as_of_join, lookup_join
from tollbook.schemas import RATED_COLUMNS, USAGE_COLUMNS, VOLUME
from tollbook.tariff import DEFAULT_TARIFF, Tariff

RATE_CARD = (
    "rate_key string, price decimal(12,8), threshold_mb double, price_above decimal(12,8)"
)


def to_usage(records: DataFrame) -> DataFrame:
    """Accepted records reduced to the columns pricing and billing need."""
    return records.withColumns(
        {"event_time": F.col("timestamp"), "user_identifier": fields.subscriber()}
    ).select(*USAGE_COLUMNS)


def price(usage: DataFrame, tariff: Tariff = DEFAULT_TARIFF) -> DataFrame:
    """Add cost and rating status."""
    return (
        usage.withColumn("cost", pricing.cost(tariff))
        .withColumn("rating_status", pricing.rating_status(pricing.unit_price(tariff)))
        .select(*RATED_COLUMNS)
    )


def rate_key(tariff: Tariff = DEFAULT_TARIFF) -> Column:
    """The line of the rate card an event is priced by."""
    service = F.col("record_type")
    band = F.when(pricing.is_peak(F.col("event_time"), tariff), F.lit("peak")).otherwise(
        F.lit("base")
    )
    return (
        F.when(service == "voice", F.concat(F.lit("voice/"), band))
        .when(service == "sms", F.lit("sms/flat"))
        .when(service == "data", F.concat(F.lit("data/"), F.col("technology")))
    )


def rate_card(spark: SparkSession, tariff: Tariff = DEFAULT_TARIFF) -> DataFrame:
    """The tariff as a table; any table of this layout can take its place."""
    lines = [
        ("voice/peak", tariff.voice_peak_rate, None, None),
        ("voice/base", tariff.voice_rate, None, None),
        ("sms/flat", tariff.sms_price, None, None),
    ]
    for technology, rate in tariff.data_rates.items():
        discounted = rate * (Decimal(1) - tariff.volume_discount)
        lines.append(
            (f"data/{technology}", rate, float(tariff.volume_threshold_mb), discounted)
        )
    return spark.createDataFrame(lines, RATE_CARD)


def _chosen_price() -> Column:
    above = F.col("data_volume_mb") > F.col("threshold_mb")
    return F.when((F.col("record_type") == "data") & above, F.col("price_above")).otherwise(
        F.col("price")
    )


def price_by_card(
    usage: DataFrame,
    card: DataFrame,
    tariff: Tariff = DEFAULT_TARIFF,
    max_broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Same result as ``price``, with the prices joined from a table."""
    doubled = card.groupBy("rate_key").count().filter("count > 1").limit(1).count()
    if doubled:
        raise ValueError("the rate card has more than one price for a rate_key")
    keyed = usage.withColumn("rate_key", rate_key(tariff))
    spread = F.xxhash64(*USAGE_COLUMNS)
    priced = lookup_join(keyed, card, ["rate_key"], spread, max_rows=max_broadcast_rows)
    chosen = _chosen_price()
    return (
        priced.withColumn("cost", pricing.charge(chosen))
        .withColumn("rating_status", pricing.rating_status(chosen))
        .select(*RATED_COLUMNS)
    )


def price_by_dated_card(
    usage: DataFrame, card: DataFrame, tariff: Tariff = DEFAULT_TARIFF, blocks: int | None = None
) -> DataFrame:
    """Prices from a rate card whose lines hold from ``valid_from`` to before
    ``valid_to``: an event is priced by the line of its time. One without such a line has
    no cost and is unrated, and the load filter drops and counts it."""
    keyed = usage.withColumn("rate_key", rate_key(tariff))
    priced = as_of_join(keyed, card, ["rate_key"], "event_time", blocks=blocks)
    chosen = _chosen_price()
    return (
        priced.withColumn("cost", pricing.charge(chosen))
        .withColumn("rating_status", pricing.rating_status(chosen))
        .select(*RATED_COLUMNS)
    )


def fill_and_clamp(rated: DataFrame) -> DataFrame:
    """No NULL and no negative quantities; volume as the table stores it, NULL
    only where it does not fit, which ``load_report`` counts."""
    return rated.withColumns(
        {
            "duration_sec": fields.not_negative(F.col("duration_sec"), F.lit(0)),
            "data_volume_mb": fields.not_negative(
                F.col("data_volume_mb").cast("double"), F.lit(0.0)
            ).try_cast(VOLUME),
        }
    )


def loadable() -> Column:
    return (
        F.col("cell_id").isNotNull() & F.col("user_identifier").isNotNull() & (F.col("cost") >= 0)
    )


def sanitize(rated: DataFrame) -> DataFrame:
    """The rows that may enter the rated-events table, in its layout."""
    rows = fill_and_clamp(rated).filter(loadable())
    return rows.select(fields.event_key().alias("event_id"), *RATED_COLUMNS)


def load_report(rated: DataFrame) -> DataFrame:
    """How many rows ``sanitize`` keeps, and how many it drops for which reason."""
    missing_cell = F.col("cell_id").isNull()
    missing_user = F.col("user_identifier").isNull()
    return rated.agg(
        F.count("*").alias("read_rows"),
        F.count_if(loadable()).alias("loaded_rows"),
        F.count_if(missing_cell).alias("without_cell"),
        F.count_if(missing_user).alias("without_subscriber"),
        F.count_if(F.col("cost").isNull()).alias("without_price"),
        F.count_if(F.col("cost") < 0).alias("negative_cost"),
        F.count_if(
            F.col("data_volume_mb").isNotNull() & F.col("data_volume_mb").try_cast(VOLUME).isNull()
        ).alias("volume_too_wide"),
    )


def status_counts(rated: DataFrame) -> DataFrame:
    return rated.groupBy("record_type", "rating_status").agg(
        F.count("*").alias("events"), F.sum("cost").alias("total_cost")
    )


def rated_only(rated: DataFrame) -> DataFrame:
    return rated.filter(F.col("rating_status") == "rated")
