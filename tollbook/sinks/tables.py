"""Table and document sinks. Writing the same thing twice leaves one copy."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollbook.operators import billing, quality, rating
from tollbook.schemas import PERIOD_COLUMNS
from tollbook.sources import live


def with_period(rated: DataFrame) -> DataFrame:
    return rated.withColumns(
        {"billing_year": F.year("event_time"), "billing_month": F.month("event_time")}
    )


# Rows that a task of a micro-batch writes, about.
TASK_ROWS = 1_000_000


def sized_for_write(rows: DataFrame, task_rows: int = TASK_ROWS) -> DataFrame:
    """Rebalance by period, so that each folder gets few files of good size;
    a month too large for one task is split by adaptive execution. Inside a
    micro-batch that is off: there the rows of each period are counted, from the
    batch that is kept, and spread over as many tasks as they need."""
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return rows.hint("rebalance", *[F.col(c) for c in PERIOD_COLUMNS])
    counts = rows.groupBy(*PERIOD_COLUMNS).count().collect()
    tasks = {tuple(row[:2]): math.ceil(row["count"] / task_rows) for row in counts}
    shares = F.lit(1)
    for (year, month), number in tasks.items():
        here = F.col("billing_year").eqNullSafe(F.lit(year)) & F.col("billing_month").eqNullSafe(F.lit(month))
        shares = F.when(here, number).otherwise(shares) if number > 1 else shares
    share = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in PERIOD_COLUMNS]), shares)
    return rows.withColumn("_share", share).repartition(max(1, sum(tasks.values())), *PERIOD_COLUMNS, "_share").drop("_share")


def write_rated(rated: DataFrame, path: str) -> None:
    """Sanitized events into a folder tree by period, replacing what is there."""
    sized_for_write(with_period(rated)).write.mode("overwrite").partitionBy(
        *PERIOD_COLUMNS
    ).parquet(path)


def write_batch(
    rated: DataFrame, path: str, writer: str, batch_id: int, ledger_path: str | None = None
) -> None:
    """Sanitized events of one batch, each period's below that period: a reader of
    some periods lists their folders alone. The batch replaces its own folders, those
    of periods that it no longer has as well, and its rows in compacted files.

    With a ledger, violations of declared constraints are counted by the tasks that
    write the rows, and the batch's line in the ledger replaces the one it had."""
    spark = rated.sparkSession
    owned = with_period(rated).withColumns(
        {"writer": F.lit(writer), "batch_id": F.lit(batch_id).cast("bigint")}
    )
    folders = live.Folders(spark, path)
    places = {period: live.batch_place(folders, period, (writer, batch_id)) for period in live.periods_of(folders)}
    before = {period: place for period, place in places.items() if folders.exists(place)}
    if before:
        now = {tuple(row) for row in owned.select(*PERIOD_COLUMNS).distinct().collect()}
        gone = [place for period, place in before.items() if period not in now]
    sized, violations = sized_for_write(owned), None
    if ledger_path:
        sized, violations = quality.counted_on_the_way(sized, "rated_events")
    sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *PERIOD_COLUMNS, "writer", "batch_id"
    ).parquet(path)
    if violations:
        lines = [("rated_events", rule, count, writer, batch_id) for rule, count in violations().items()]
        spark.createDataFrame(lines, LEDGER).coalesce(1).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("writer", "batch_id").parquet(ledger_path)
    live.hide_rewritten(spark, path, (writer, batch_id))
    for place in gone if before else []:
        folders.remove(place)


LEDGER = "table_name string, rule string, violations bigint, writer string, batch_id bigint"


def quality_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """What each batch was found to violate when it was written."""
    return spark.read.schema(LEDGER).parquet(ledger_path)


def batch_folder(path: str, writer: str, batch_id: int) -> str:
    return f"{path}/writer={writer}/batch_id={batch_id}"


def rated_batch_writer(
    path: str, writer: str, report_path: str | None = None, ledger_path: str | None = None
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that loads priced events into a table.

    Each micro-batch owns the folders named by writer and batch number and
    replaces them, so a batch repeated after a failure is not counted twice. The batch is computed once and kept for its two or three uses.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            if report_path:
                rating.load_report(batch).write.mode("overwrite").parquet(
                    batch_folder(report_path, writer, batch_id)
                )
            events = rating.sanitize(batch)
            if events.isEmpty():
                return
            write_batch(events, path, writer, batch_id, ledger_path)
        finally:
            batch.unpersist()

    return load


def jdbc_batch_writer(
    options: dict[str, str], writer: str
) -> Callable[[DataFrame, int], None]:
    """The same for a database table that has a ``batch_key`` column.

    An append that failed half-way leaves some of its rows behind. The repeat
    reads back only the rows of its own batch and appends the missing ones.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            if batch.isEmpty():
                return
            append_batch(rating.sanitize(batch), options, f"{writer}/{batch_id}")
        finally:
            batch.unpersist()

    return load


def append_batch(events: DataFrame, options: dict[str, str], batch_key: str) -> None:
    table = events.sparkSession.read.format("jdbc").options(**options).load()
    missing_rows(events, table, batch_key).write.format("jdbc").options(**options).mode(
        "append"
    ).save()


def missing_rows(events: DataFrame, table: DataFrame, batch_key: str) -> DataFrame:
    """Rows of this batch the table does not hold yet."""
    present = table.filter(F.col("batch_key") == batch_key).select("event_id")
    return events.join(present, "event_id", "left_anti").withColumn(
        "batch_key", F.lit(batch_key)
    )


# Fixed value: the type of the invoice total in a table created by the sink.
INVOICE_COLUMN_TYPES = "total_cost DECIMAL(10,2)"


def append_invoices(invoices: DataFrame, options: dict[str, str]) -> None:
    """Service invoices into a database table, created on first use."""
    invoices.write.format("jdbc").options(**options).option(
        "createTableColumnTypes", INVOICE_COLUMN_TYPES
    ).mode("append").save()


def append_summary(
    summary: DataFrame, options: dict[str, str], generated_at: datetime | None = None
) -> None:
    """The billing summary, stamped, into a database table."""
    billing.stamped(summary, generated_at).write.format("jdbc").options(**options).mode("append").save()


def write_summary(summary: DataFrame, path: str, generated_at: datetime | None = None) -> None:
    """The billing summary by period: periods in it are replaced, others stay."""
    sized_for_write(billing.stamped(summary, generated_at)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PERIOD_COLUMNS).parquet(path)


def write_documents(
    summary: DataFrame, path: str, generated_at: datetime | None = None
) -> str:
    """Invoice documents, one JSON object per line, in one folder per run."""
    moment = generated_at or datetime.now(UTC)
    # Two runs may fall into one second; a stamp that was passed in names its run.
    name = f"{moment:%Y%m%d_%H%M%S}" if generated_at else f"{moment:%Y%m%d_%H%M%S_%f}"
    folder = f"{path}/invoice_batch_{name}"
    documents = billing.stamped(billing.documents(summary), moment)
    documents.write.mode("overwrite" if generated_at else "errorifexists").json(folder)
    return folder


def preview(rows: DataFrame, count: int = 5) -> None:
    rows.show(count, truncate=False)
