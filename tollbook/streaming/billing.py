"""Re-billing of the periods that received new events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tollbook.operators import billing
from tollbook.schemas import PERIOD_COLUMNS, RATED_TABLE_ON_DISK
from tollbook.sinks.streams import start_batch_sink
from tollbook.sinks.tables import write_summary
from tollbook.sources.tables import rated_events
from tollbook.streaming import partials
from tollbook.tariff import DEFAULT_TERMS, BillingTerms


def rebill(
    spark: SparkSession,
    table_path: str,
    summary_path: str,
    periods: list[tuple[int, int]],
    terms: BillingTerms = DEFAULT_TERMS,
) -> None:
    """Bill whole periods again and replace them in the summary."""
    events = rated_events(spark, table_path, periods, only_rated=True)
    write_summary(billing.summary(billing.bill(events, terms)), summary_path)


def start_rebilling(
    spark: SparkSession,
    table_path: str,
    summary_path: str,
    checkpoint: str,
    terms: BillingTerms = DEFAULT_TERMS,
) -> StreamingQuery:
    """One scheduled run: find the periods of events added since the last run
    and bill those periods. A run without new events does nothing.

    Only the list of periods, twelve per year of data, reaches the driver; it
    comes from folder names and file footers.
    """

    def load(batch: DataFrame, _: int) -> None:
        touched = [tuple(row) for row in batch.select(*PERIOD_COLUMNS).distinct().collect()]
        if touched:
            # In the caller's session: the micro-batch's has adaptive execution off.
            rebill(spark, table_path, summary_path, touched, terms)

    arrivals = spark.readStream.schema(RATED_TABLE_ON_DISK).parquet(table_path)
    return start_batch_sink(arrivals, load, checkpoint, once=True)


def start_partial_rebilling(
    spark: SparkSession,
    table_path: str,
    partials_path: str,
    summary_path: str,
    checkpoint: str,
    terms: BillingTerms = DEFAULT_TERMS,
    buckets: int = partials.BUCKETS,
) -> StreamingQuery:
    """The same from sums kept by batch: a run reads the batches that arrived since the
    last one, replaces their sums and bills the buckets of subscribers that they touch.

    Events of other batches are not read. The driver gets the arrived batches and the
    changed buckets, both from folder names. The summary is kept by month and bucket.
    A run repeated after a failure ends in the same state.
    """

    def load(batch: DataFrame, number: int) -> None:
        arrived = sorted(map(tuple, batch.select(*partials.BATCH_COLUMNS).distinct().collect()))
        if arrived:
            noted = f"{checkpoint.rstrip('/')}/changed/{number}"
            changes = partials.update_sums(spark, table_path, partials_path, arrived, noted, buckets)
            partials.write_changed_bills(partials.changed_bills(spark, partials_path, changes, terms), summary_path, changes)

    arrivals = spark.readStream.schema(RATED_TABLE_ON_DISK).option("ignoreMissingFiles", "true").parquet(table_path)
    return start_batch_sink(arrivals, load, checkpoint, once=True)
