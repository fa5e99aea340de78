"""The jobs as commands, for ``spark-submit``:

    jobs.py mediation --from-text IN --clean-text OUT --dead-letter-text OUT --checkpoint DIR
    jobs.py rating    --from-topic BROKERS TOPIC --jdbc-url URL --checkpoint DIR
    jobs.py invoices  --table PATH --jdbc-url URL
    jobs.py billing   --table PATH --summary PATH --documents PATH

A topic needs the Kafka connector and a database its driver on the class path.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from tollbook.operators import billing
from tollbook.session import apply_settings
from tollbook.sinks import tables as sinks
from tollbook.sources import streams
from tollbook.sources import tables as sources
from tollbook.streaming import mediation, rating
from tollbook.streaming.lifecycle import run_forever, run_to_end


def service_invoices(rated: DataFrame, invoice_date: date | None = None) -> DataFrame:
    """The invoice job's rows: what each subscriber owes per service."""
    return billing.service_pivot(rated, invoice_date)


def billing_rows(rated: DataFrame) -> DataFrame:
    """The billing job's rows, from rated events alone."""
    return billing.summary(billing.bill(rated))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="jobs.py")
    jobs = top.add_subparsers(dest="job", required=True)

    def source(job: argparse.ArgumentParser) -> None:
        either = job.add_mutually_exclusive_group(required=True)
        either.add_argument("--from-text", metavar="PATH")
        either.add_argument("--from-topic", nargs=2, metavar=("BROKERS", "TOPIC"))
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--once", action="store_true", help="stop when caught up")
        job.add_argument("--state-partitions", type=int)

    def output(job: argparse.ArgumentParser, name: str) -> None:
        either = job.add_mutually_exclusive_group(required=True)
        either.add_argument(f"--{name}-text", metavar="PATH")
        either.add_argument(f"--{name}-topic", nargs=2, metavar=("BROKERS", "TOPIC"))

    def database(job: argparse.ArgumentParser, table: str) -> None:
        job.add_argument("--jdbc-url")
        job.add_argument("--jdbc-table", default=table)
        job.add_argument("--jdbc-user")
        job.add_argument("--jdbc-password")
        job.add_argument("--jdbc-driver")

    def events(job: argparse.ArgumentParser) -> None:
        job.add_argument("--table", help="folder of rated events; without it the database's")
        job.add_argument("--split", nargs=3, metavar=("COLUMN", "LOWER", "UPPER"))
        job.add_argument("--partitions", type=int, default=64)

    job = jobs.add_parser("mediation")
    source(job)
    output(job, "clean")
    output(job, "dead-letter")
    job = jobs.add_parser("rating")
    source(job)
    job.add_argument("--table", help="folder of rated events")
    job.add_argument("--writer", default="rating")
    database(job, "rated_events")
    job = jobs.add_parser("invoices")
    events(job)
    database(job, "invoices")
    job = jobs.add_parser("billing")
    events(job)
    database(job, "billing_summary")
    job.add_argument("--summary", help="folder of the summary; without it the database's")
    job.add_argument("--documents", help="folder of the invoice documents")
    job.add_argument("--generated-at", type=datetime.fromisoformat)
    return top


def jdbc(options: argparse.Namespace, table: str, **split) -> dict[str, str]:
    if not options.jdbc_url:
        raise SystemExit("neither a folder nor --jdbc-url is given")
    return sources.jdbc_options(
        options.jdbc_url, table, options.jdbc_user, options.jdbc_password, options.jdbc_driver, **split
    )


def read_stream(spark: SparkSession, options: argparse.Namespace) -> DataFrame:
    if options.from_text:
        return streams.text_stream(spark, options.from_text, ignore_missing_files=True)
    return streams.topic_stream(spark, streams.topic_options(*options.from_topic))


def read_rated(spark: SparkSession, options: argparse.Namespace, only_rated: bool) -> DataFrame:
    """Rated events from a folder, or from a database in ranges of a column."""
    if options.table:
        return sources.rated_events(spark, options.table, only_rated=only_rated)
    split = {}
    if options.split:
        column, lower, upper = options.split
        split = {"split_column": column, "lower": lower, "upper": upper, "partitions": options.partitions}
    return sources.jdbc_rated_events(spark, jdbc(options, "rated_events", **split), only_rated)


def sink(path: str | None, topic: Sequence[str] | None) -> mediation.Sink:
    return mediation.text_sink(path) if path else mediation.topic_sink(*topic)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.job in ("mediation", "rating"):
        values = read_stream(spark, options)
        how = {"once": options.once, "state_partitions": options.state_partitions}
        if options.job == "mediation":
            queries = mediation.start_mediation(
                values,
                sink(options.clean_text, options.clean_topic),
                sink(options.dead_letter_text, options.dead_letter_topic),
                options.checkpoint,
                **how,
            )
        else:
            table = options.table or sinks.jdbc_batch_writer(
                jdbc(options, options.jdbc_table), options.writer
            )
            queries = [rating.start_rating(values, table, options.checkpoint, options.writer, **how)]
        if options.once:
            run_to_end(*queries)
        else:
            run_forever(spark)
    elif options.job == "invoices":
        rows = service_invoices(read_rated(spark, options, only_rated=False))
        sinks.append_invoices(rows, jdbc(options, options.jdbc_table))
    else:
        rows = billing_rows(read_rated(spark, options, only_rated=True))
        if options.summary:
            sinks.write_summary(rows, options.summary, options.generated_at)
            rows = spark.read.parquet(options.summary)
        else:
            sinks.append_summary(rows, jdbc(options, options.jdbc_table), options.generated_at)
        if options.documents:
            sinks.write_documents(rows, options.documents, options.generated_at)


def main(arguments: Sequence[str] | None = None) -> None:
    options = parser().parse_args(arguments)
    spark = apply_settings(SparkSession.builder.appName(options.job)).getOrCreate()
    run(spark, options)


if __name__ == "__main__":
    main()
