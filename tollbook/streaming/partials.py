"""Sums per subscriber, month and service that each batch contributes, kept by batch, and
bills made from them.

The table of sums mirrors the batches of the rated-events table: below ``billing_year=/
billing_month=/writer=/batch_id=`` are the sums of that batch's events, each row with the
bucket of its subscriber. A batch that is written again replaces its sums. Bills are
kept by month and bucket, so an event that comes late costs the reading of its batch, of
the sums in its subscriber's bucket of one month, and the writing of that bucket's bills.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.operators import billing
from tollbook.operators.rating import rated_only
from tollbook.schemas import PERIOD_COLUMNS
from tollbook.sources import live
from tollbook.sources.tables import batch_rows, rated_events
from tollbook.tariff import DEFAULT_TERMS, BillingTerms

#: Parts that the bills of a month are kept in; part of what is stored, so fixed for a
#: table. Take one for about every million subscribers.
BUCKETS = 64
#: Sums a task writes, about.
TASK_SUMS = 2_000_000
BATCH_COLUMNS = (*PERIOD_COLUMNS, "writer", "batch_id")
SUMS = (
    "user_identifier string, record_type string, total_duration_sec bigint, total_data_mb decimal(20,2), "
    "total_cost decimal(20,4), event_count bigint, bucket int"
)
SUMS_ON_DISK = f"{SUMS}, billing_year int, billing_month int, writer string, batch_id bigint"
MERGED_ON_DISK = f"{SUMS}, billing_year int, billing_month int"

Batch = tuple[int, int, str, int]
Changes = list[tuple[live.Period, list[int]]]


def bucket_of(user: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(buckets)).cast("int")


def batch_sums(events: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Events with their writer and batch number to what each batch contributes."""
    usage = billing.monthly_usage(rated_only(events), "writer", "batch_id")
    return usage.withColumn("bucket", bucket_of(F.col("user_identifier"), buckets))


def _read(spark: SparkSession, path: str, places: list[str]) -> DataFrame:
    """The sums in some batch folders."""
    if not places:
        return spark.createDataFrame([], SUMS_ON_DISK)
    folders = [f"{path.rstrip('/')}/{place}" for place in places]
    return spark.read.schema(SUMS_ON_DISK).option("basePath", path).parquet(*folders)


def period_sums(spark: SparkSession, path: str, period: live.Period) -> DataFrame:
    """All sums of a month: those of batches with folders, and those merged."""
    folders = live.Folders(spark, path)
    held = live.current_list(folders, period)
    parts = _read(spark, path, list(live.live_folders(folders, period, held).values())).drop("writer", "batch_id")
    if not held.generation:
        return parts
    return parts.unionByName(_merged(spark, folders, period, held))


def _merged(spark: SparkSession, folders: live.Folders, period: live.Period, held: live.LiveList) -> DataFrame:
    rows = spark.read.schema(MERGED_ON_DISK).option("basePath", f"{folders.root}/_compacted")
    return rows.parquet(f"{folders.root}/{live.compacted_folder(period, held.generation)}").drop("generation")


def touched_batches(spark: SparkSession, path: str, arrived: list[Batch]) -> list[Batch]:
    """The batches that arrived, in every month whose sums they are in: a batch that was
    written again may have left a month, of which nothing arrives."""
    folders = live.Folders(spark, path)
    written = {(writer, number) for _, _, writer, number in arrived}
    found = set(arrived)
    for period in live.periods_of(folders):
        held = live.current_list(folders, period)
        found |= {
            (*period, *batch)
            for batch in written
            if held.covers(batch) or folders.exists(live.batch_place(folders, period, batch))
        }
    return sorted(found)


def update_sums(
    spark: SparkSession, table_path: str, path: str, arrived: list[Batch], noted: str, buckets: int = BUCKETS
) -> Changes:
    """Bring the sums of batches up to date with their folders in the events table;
    returns which buckets of which months changed.

    Only the folders of those batches are read. What changes is written down in the
    folder ``noted`` before any sum is replaced: a run repeated after a failure, with the
    same folder, bills what the failed one would have, also for subscribers that a new
    version of a batch no longer has. A batch whose sums were merged can't be taken out
    of them; the sums of its month are then made anew from the month's events.
    """
    folders, events = live.Folders(spark, path), live.Folders(spark, table_path)
    batches = touched_batches(spark, path, arrived)
    months = sorted({batch[:2] for batch in batches})
    places = {batch: live.batch_place(folders, batch[:2], batch[2:]) for batch in batches}
    sources = {batch: place for batch, place in places.items() if events.exists(place)}
    known = {batch: place for batch, place in places.items() if folders.exists(place)}
    merged = {m: live.current_list(folders, m) for m in months}
    anew = sorted({b[:2] for b in batches if merged[b[:2]].covers(b[2:])})
    sums = batch_sums(batch_rows(spark, table_path, [sources[b] for b in batches if b in sources]), buckets).persist()
    try:
        notes = live.Folders(spark, noted)
        if not notes.exists("_SUCCESS"):
            keys = [*PERIOD_COLUMNS, "bucket"]
            changed = sums.select(*keys).union(_read(spark, path, [known[b] for b in batches if b in known]).select(*keys))
            every = spark.createDataFrame(
                [(*m, bucket) for m in anew for bucket in range(buckets)], "billing_year int, billing_month int, bucket int"
            )
            changed.union(every).distinct().coalesce(1).write.mode("overwrite").parquet(noted)
        _write(sums, path)
        for batch in batches:
            if batch in known and batch not in sources:
                folders.remove(known[batch])
    finally:
        sums.unpersist()
    for month in anew:
        _merge_again(spark, table_path, path, month, buckets)
    found: dict[live.Period, list[int]] = {}
    for year, month, bucket in sorted(map(tuple, spark.read.parquet(noted).collect())):
        found.setdefault((year, month), []).append(bucket)
    return sorted(found.items())


def _write(sums: DataFrame, path: str) -> None:
    """Each batch's sums into its folder, in the order of buckets, so that readers of some
    skip row groups; by as many tasks as there are sums for."""
    tasks = max(1, math.ceil(sums.count() / TASK_SUMS))
    names = [column.split()[0] for column in SUMS_ON_DISK.split(", ")]
    placed = sums.select(*names).repartitionByRange(tasks, *BATCH_COLUMNS, "bucket", "user_identifier")
    placed.sortWithinPartitions(*BATCH_COLUMNS, "bucket", "user_identifier").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*BATCH_COLUMNS).parquet(path)


def _merge_again(spark: SparkSession, table_path: str, path: str, month: live.Period, buckets: int) -> None:
    """The sums of a month from all its events, and no batch folder beside them."""
    folders, events = live.Folders(spark, path), live.Folders(spark, table_path)
    covered = dict(live.current_list(events, month).covered)
    for writer, number in [*live.batches_of(events, month), *live.batches_of(folders, month)]:
        covered[writer] = max(number, covered.get(writer, -1))
    # A batch that is loaded just now has a higher number; its own run will see to it.
    rows = rated_events(spark, table_path, [month]).filter(_inside(covered))
    _commit_merged(spark, folders, month, billing.merged_usage(batch_sums(rows, buckets)), covered, buckets)


def _inside(covered: dict[str, int]) -> Column:
    inside = F.lit(False)
    for writer, number in sorted(covered.items()):
        inside = inside | ((F.col("writer") == writer) & (F.col("batch_id") <= number))
    return inside


def _commit_merged(
    spark: SparkSession, folders: live.Folders, month: live.Period, usage: DataFrame, covered: dict[str, int], buckets: int
) -> None:
    held = live.current_list(folders, month)
    new = live.LiveList(held.version, held.generation + 1, covered)
    rows = usage.withColumn("bucket", bucket_of(F.col("user_identifier"), buckets)).drop(*PERIOD_COLUMNS)
    rows = rows.repartitionByRange("bucket", "user_identifier").sortWithinPartitions("bucket", "user_identifier")
    rows.write.mode("overwrite").parquet(f"{folders.root}/{live.compacted_folder(month, new.generation)}")
    live.commit(folders, month, new)


def merge_sums(spark: SparkSession, path: str, keep: int = 1, buckets: int = BUCKETS) -> list[live.Period]:
    """Add up the sums of each month's batches but each writer's newest ``keep``, which may
    still be written again, so that a month's reading stays bounded however many batches
    there were. Readers see the sums before or after. Returns the months merged."""
    folders = live.Folders(spark, path)
    done = []
    for month in live.periods_of(folders):
        held = live.current_list(folders, month)
        counted = live.live_folders(folders, month, held)
        covered = dict(held.covered)
        for writer in {w for w, _ in counted}:
            numbers = sorted(n for w, n in counted if w == writer)
            for number in numbers[: max(0, len(numbers) - keep)]:
                covered[writer] = max(number, covered.get(writer, -1))
        new = live.LiveList(covered=covered)
        taken = [place for batch, place in counted.items() if new.covers(batch)]
        if not taken:
            continue
        parts = _read(spark, path, taken).drop("writer", "batch_id")
        if held.generation:
            parts = parts.unionByName(_merged(spark, folders, month, held))
        _commit_merged(spark, folders, month, billing.merged_usage(parts), covered, buckets)
        done.append(month)
    return done


def changed_bills(spark: SparkSession, path: str, changes: Changes, terms: BillingTerms = DEFAULT_TERMS) -> DataFrame:
    """The bills of the changed buckets, with their bucket, from sums alone."""
    parts = [
        period_sums(spark, path, month).filter(F.col("bucket").isin(buckets)) for month, buckets in changes
    ] or [spark.createDataFrame([], MERGED_ON_DISK)]
    sums = reduce(DataFrame.unionByName, parts)
    bucket = F.first("bucket").alias("bucket")
    kinds = dict(sums.dtypes)
    usage = sums.groupBy(*billing.USAGE_KEY).agg(
        *[F.sum(name).cast(kinds[name]).alias(name) for name in billing.USAGE_SUMS], bucket
    )
    return billing.summary(billing.bill_usage(usage, terms), "bucket")


def write_changed_bills(bills: DataFrame, summary_path: str, changes: Changes) -> None:
    """Replace the changed buckets of the summary; a bucket without bills goes."""
    spark = bills.sparkSession
    bills = bills.persist()
    try:
        keys = [*PERIOD_COLUMNS, "bucket"]
        left = {tuple(row) for row in bills.select(*keys).distinct().collect()}
        tasks = max(1, math.ceil(bills.count() / TASK_SUMS))
        billing.stamped(bills).repartitionByRange(max(tasks, min(len(left), 64)), *keys, "customer_id").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy(*keys).parquet(summary_path)
    finally:
        bills.unpersist()
    folders = live.Folders(spark, summary_path)
    for month, buckets in changes:
        for bucket in buckets:
            if (*month, bucket) not in left:
                folders.remove(live.period_name(month), f"bucket={bucket}")
