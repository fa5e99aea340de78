"""The queries by name: each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tollbook import jobs
from tollbook.functions import fields, pricing, validity
from tollbook.operators import billing, dedup, invoicing, joins, lateness, mediation, quality, rating
from tollbook.plans import chains, event_log
from tollbook.schemas import (
    CDR_COLUMNS,
    PERIOD_COLUMNS,
    RATED_TABLE,
    RAW_CDR,
    SUMMARY_COLUMNS,
)
from tollbook.session import folder_bytes, prepare, shared_folder, state_partitions
from tollbook.sinks import compaction
from tollbook.sinks import tables as table_sinks
from tollbook.sinks.streams import start_text_sink
from tollbook.sources import streams
from tollbook.sources import tables as table_sources
from tollbook.sources.live import Folders
from tollbook.streaming import billing as billing_job
from tollbook.streaming import mediation as mediation_job
from tollbook.streaming import partials, single_pass
from tollbook.streaming import rating as rating_job
from tollbook.streaming.lifecycle import counting_late_rows, run_to_end
from tollbook.tariff import BillingTerms

Query = Callable[[SparkSession, str], DataFrame]
Start = Callable[..., StreamingQuery | list[StreamingQuery]]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain_times(rows: DataFrame) -> DataFrame:
    """Event times without a zone, so that clients show them as stored."""
    return rows.withColumns(
        {
            f.name: F.col(f.name).cast("timestamp_ntz")
            for f in rows.schema.fields
            if isinstance(f.dataType, T.TimestampType)
        }
    )


def reasons_text() -> Column:
    return F.array_join(validity.reject_reasons(), ",").alias("reasons")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/events.parquet")


def records(spark: SparkSession, folder: str) -> DataFrame:
    return event_log.to_records(events(spark, folder))


def rated(spark: SparkSession, folder: str) -> DataFrame:
    return chains.rated_events(records(spark, folder))


def stored_rated(spark: SparkSession, folder: str) -> DataFrame:
    """The rated-events table written out, for queries that read it repeatedly."""
    path = f"{shared_folder(spark)}/rated"
    table_sinks.write_rated(rated(spark, folder), path)
    return spark.read.schema(RATED_TABLE).parquet(path)


# --- mediation -------------------------------------------------------------


@query
def cdr_from_events(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(records(spark, folder))


@query
def cdr_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    wire = event_log.to_wire(records(spark, folder))
    parsed = mediation.type_event_time(mediation.parse_raw(wire))
    return plain_times(parsed.select(*CDR_COLUMNS))


@query
def cdr_validated(spark: SparkSession, folder: str) -> DataFrame:
    flagged = mediation.flag_valid(records(spark, folder))
    return flagged.select("event_id", "record_type", "is_valid", reasons_text())


@query
def cdr_validated_per_service(spark: SparkSession, folder: str) -> DataFrame:
    flagged = mediation.flag_valid(records(spark, folder), per_service_technology=True)
    return flagged.groupBy("record_type", "technology").agg(
        F.count_if("is_valid").alias("valid"), F.count_if(~F.col("is_valid")).alias("rejected")
    )


@query
def cdr_clean(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(chains.unique_records(records(spark, folder)))


@query
def cdr_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    lost = mediation.rejected(mediation.flag_valid(records(spark, folder)))
    return plain_times(lost.select(*CDR_COLUMNS, "is_valid", reasons_text()))


@query
def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    return quality.reason_counts(mediation.flag_valid(records(spark, folder)))


@query
def event_time_formats(spark: SparkSession, folder: str) -> DataFrame:
    """Event times written in seven shapes, of which four are accepted."""

    def shape(pattern: str):
        return F.date_format(F.col("ts").cast("timestamp"), pattern)

    shapes = [
        shape("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        shape("yyyy-MM-dd'T'HH:mm:ss'Z'"),
        shape("yyyy-MM-dd'T'HH:mm:ss"),
        shape("yyyy-MM-dd"),
        shape("yyyy-MM-dd HH:mm:ss"),
        F.concat(shape("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")),
        F.lit("INVALID"),
    ]
    kind = (F.col("event_id") % len(shapes)).cast("int")
    text = F.get(F.array(*shapes), kind)
    return plain_times(
        events(spark, folder).select("event_id", fields.event_time(text).alias("parsed"))
    )


def damaged_wire(spark: SparkSession, folder: str) -> DataFrame:
    """Wire text with ``event_id``, in which every eleventh line is no JSON and the
    call durations of the others take turns in being badly typed."""
    wire = event_log.to_wire(records(spark, folder), "event_id")
    shapes = [F.lit("60"), F.lit('"INVALID"'), F.lit("5.5"), F.lit('"5"'), F.lit("null")]
    shape = F.get(F.array(*shapes), (F.col("event_id") % 5).cast("int"))
    damaged = F.regexp_replace(
        "value", F.lit(r'"duration_sec":-?\d+'), F.concat(F.lit('"duration_sec":'), shape)
    )
    text = F.when(F.col("event_id") % 11 == 0, F.lit("not json")).otherwise(damaged)
    return wire.select("event_id", text.alias("value"))


@query
def json_wrong_types(spark: SparkSession, folder: str) -> DataFrame:
    """Records with a badly typed field, or that are no JSON at all."""
    parsed = mediation.mediate(damaged_wire(spark, folder))
    return plain_times(
        parsed.select(
            *CDR_COLUMNS, "is_valid", quality.wrong_type(F.col("raw")).alias("wrong_type")
        )
    )


# --- deduplication ---------------------------------------------------------


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    return mediation.clean_records(mediation.flag_valid(records(spark, folder)))


@query
def dedup_subscriber_key(spark: SparkSession, folder: str) -> DataFrame:
    unique = dedup.deduplicate(_valid(spark, folder), dedup.SUBSCRIBER_KEY)
    keyed = unique.withColumn("subscriber", fields.subscriber())
    return plain_times(keyed.select(*dedup.SUBSCRIBER_KEY))


@query
def dedup_caller_key(spark: SparkSession, folder: str) -> DataFrame:
    unique = dedup.deduplicate(_valid(spark, folder), dedup.CALLER_KEY)
    return plain_times(unique.select(*dedup.CALLER_KEY))


@query
def repeated_records(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(dedup.repeated(_valid(spark, folder), dedup.SUBSCRIBER_KEY))


# --- rating ----------------------------------------------------------------


@query
def rated_events(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(rated(spark, folder))


@query
def rated_via_rate_card(spark: SparkSession, folder: str) -> DataFrame:
    usage = chains.unique_usage(records(spark, folder))
    priced = rating.price_by_card(usage, rating.rate_card(spark))
    return plain_times(rating.sanitize(priced))


@query
def rated_via_shuffled_rate_card(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the shuffled join, over all records: those of unknown
    services have no line in the rate card and no key."""
    usage = rating.to_usage(records(spark, folder))
    priced = rating.price_by_card(usage, rating.rate_card(spark), max_broadcast_rows=0)
    return plain_times(rating.fill_and_clamp(priced))


@query
def tiny_volumes(spark: SparkSession, folder: str) -> DataFrame:
    """Volumes a two-millionth of the records', many of which cost less than the
    cost column can show: they are billed all the same."""
    usage = rating.to_usage(records(spark, folder)).filter(F.col("record_type") == "data")
    tiny = usage.withColumn("data_volume_mb", F.col("data_volume_mb") / F.lit(2e6))
    return (
        rating.price(tiny)
        .groupBy("technology", "rating_status")
        .agg(
            F.count("*").alias("events"),
            F.count_if(F.col("cost") == 0).alias("shown_as_zero"),
        )
    )


@query
def rating_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    return rating.status_counts(chains.priced_events(records(spark, folder)))


@query
def load_report(spark: SparkSession, folder: str) -> DataFrame:
    """Over all records, accepted or not, so that every reason occurs."""
    return rating.load_report(rating.price(rating.to_usage(records(spark, folder))))


@query
def filled_and_clamped(spark: SparkSession, folder: str) -> DataFrame:
    rows = rating.fill_and_clamp(rating.price(rating.to_usage(records(spark, folder))))
    return plain_times(rows)


@query
def voice_peak_split(spark: SparkSession, folder: str) -> DataFrame:
    voice = rated(spark, folder).filter(F.col("record_type") == "voice")
    return voice.groupBy(pricing.is_peak(F.col("event_time")).alias("peak")).agg(
        F.count("*").alias("events"),
        F.sum("duration_sec").alias("seconds"),
        F.sum("cost").alias("total_cost"),
    )


@query
def volume_discount_effect(spark: SparkSession, folder: str) -> DataFrame:
    data = rated(spark, folder).filter(F.col("record_type") == "data")
    return data.groupBy("technology", pricing.above_threshold().alias("discounted")).agg(
        F.count("*").alias("events"),
        F.sum("data_volume_mb").alias("megabytes"),
        F.sum("cost").alias("total_cost"),
    )


# --- billing ---------------------------------------------------------------

# Fixed stamps, so that stamped columns can be compared.
INVOICE_DATE = date(2024, 2, 1)
GENERATED_AT = datetime(2024, 2, 1, 8, 30, tzinfo=UTC)


@query
def service_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.service_invoices(rated(spark, folder), INVOICE_DATE)


@query
def monthly_usage(spark: SparkSession, folder: str) -> DataFrame:
    return billing.monthly_usage(rating.rated_only(rated(spark, folder)))


@query
def adjusted_cost(spark: SparkSession, folder: str) -> DataFrame:
    usage = billing.monthly_usage(rating.rated_only(rated(spark, folder)))
    return billing.apply_allowance(usage)


@query
def billing_summary(spark: SparkSession, folder: str) -> DataFrame:
    return chains.billing_summary(records(spark, folder))


@query
def billing_summary_floored(spark: SparkSession, folder: str) -> DataFrame:
    return chains.billing_summary(records(spark, folder), terms=BillingTerms(floor_at_zero=True))


@query
def invoice_documents(spark: SparkSession, folder: str) -> DataFrame:
    return billing.documents(chains.billing_summary(records(spark, folder)))


@query
def invoice_header(spark: SparkSession, folder: str) -> DataFrame:
    return invoicing.invoice_headers(rated(spark, folder))


@query
def invoice_line_items(spark: SparkSession, folder: str) -> DataFrame:
    return invoicing.line_items(rated(spark, folder))


@query
def invoice_line_items_joined(spark: SparkSession, folder: str) -> DataFrame:
    loaded = stored_rated(spark, folder)
    return invoicing.line_items_of(invoicing.invoice_headers(loaded), loaded)


# --- quality ---------------------------------------------------------------


@query
def constraint_report(spark: SparkSession, folder: str) -> DataFrame:
    loaded = stored_rated(spark, folder)
    return (
        quality.constraint_report(loaded, "rated_events")
        .unionByName(
            quality.constraint_report(invoicing.invoice_headers(loaded), "invoices")
        )
        .unionByName(
            quality.constraint_report(invoicing.line_items(loaded), "invoice_line_items")
        )
    )


@query
def constraint_report_unchecked(spark: SparkSession, folder: str) -> DataFrame:
    """The same rules on priced records that were neither validated nor
    deduplicated, where most of them are broken somewhere."""
    priced = rating.price(rating.to_usage(records(spark, folder)))
    return quality.constraint_report(
        priced.withColumn("event_id", fields.event_key()), "rated_events"
    )


@query
def referential_check(spark: SparkSession, folder: str) -> DataFrame:
    loaded = stored_rated(spark, folder)
    return quality.referential_report(
        invoicing.line_items(loaded), invoicing.invoice_headers(loaded), loaded
    )


@query
def referential_check_unloaded(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of all priced events against the events that were loaded:
    the orphans are the events without a price."""
    path = f"{shared_folder(spark)}/priced"
    chains.priced_events(records(spark, folder)).write.parquet(path)
    priced = spark.read.parquet(path)
    loaded = rating.sanitize(priced)
    return quality.referential_report(
        invoicing.line_items(priced.withColumn("event_id", fields.event_key())),
        invoicing.invoice_headers(loaded),
        loaded,
    )


@query
def anomaly_report(spark: SparkSession, folder: str) -> DataFrame:
    return quality.anomaly_report(records(spark, folder), "event_id")


@query
def anomaly_report_wire(spark: SparkSession, folder: str) -> DataFrame:
    """The same from the text, where a field that is there but unreadable is corrupt
    and not missing."""
    lines = damaged_wire(spark, folder)
    raw = F.col("value").alias("raw")
    parsed = F.from_json("value", RAW_CDR).alias("data")
    typed = mediation.type_event_time(lines.select("event_id", raw, parsed).select("event_id", "raw", "data.*"))
    return quality.anomaly_report(typed, "event_id", "raw")


@query
def out_of_order_by_subscriber(spark: SparkSession, folder: str) -> DataFrame:
    flagged = quality.out_of_order(
        records(spark, folder), fields.subscriber(), "event_id", F.col("timestamp")
    )
    return flagged.groupBy(F.col("owner").alias("subscriber")).agg(
        F.sum("copies").alias("records"),
        F.sum(F.when(F.col("late"), F.col("copies")).otherwise(0)).alias("late_records"),
    )


# --- streams, run to their end ---------------------------------------------


# Deliveries the records come in, about a week's each, in the order of their times; one
# micro-batch each.
DELIVERIES = 4


def staged(wire: DataFrame, work: str) -> list[int]:
    """Write wire text once by its column ``delivery``, each with as many files as its
    bytes need; returns the deliveries there are, from folder names."""
    wire.write.partitionBy("delivery").text(f"{work}/staged")
    return _delivered(wire.sparkSession.read.text(f"{work}/staged"))


def hand_over(spark: SparkSession, work: str, number: int) -> None:
    """Let a delivery arrive: its folder moves as a whole, so that a running query takes
    all of its files as one micro-batch. One with some files only would move the
    watermark past the rest of the delivery."""
    Folders(spark, work).move(f"staged/delivery={number}", f"in/{number}")


def arrivals(spark: SparkSession, work: str) -> DataFrame:
    """A stream of what is handed over."""
    Folders(spark, work).make("in")
    return streams.text_stream(spark, f"{work}/in/*")


def _delivered(staged: DataFrame) -> list[int]:
    """The numbers of the deliveries there are, at most a few: from folder names."""
    return sorted(row[0] for row in staged.select("delivery").distinct().collect())


def _ordered_wire(rows: DataFrame) -> DataFrame:
    """The records as text with their delivery, equal spans of time each."""
    time = F.unix_micros("timestamp")
    first, last = rows.agg(F.min(time), F.max(time)).first()
    width = ((last or 0) - (first or 0)) // DELIVERIES + 1
    numbered = rows.withColumn("delivery", F.expr(f"int((unix_micros(timestamp) - {first or 0}) div {width})"))
    return event_log.to_wire(numbered, "delivery")


def _deliver(
    spark: SparkSession, folder: str, work: str, numbers: list[int], *starts: Start, idle_batches: bool = False
) -> list[StreamingQuery]:
    """Start each query once and let deliveries arrive: all queries, in the order given,
    take one before the next one comes. A start gets the stream of arrivals and settings.

    Without idle batches a delivery is measured by the watermark of the last but one;
    where rows come late on purpose, one after each delivery moves it on.
    """
    arrived, how = arrivals(spark, work), {"state_partitions": _partitions(spark, work), "idle_batches": idle_batches}
    queries: list[StreamingQuery] = []
    try:
        for begin in starts:
            started = begin(arrived, **how)
            queries += started if isinstance(started, list) else [started]
        for number in numbers:
            hand_over(spark, work, number)
            for query in queries:
                query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    return queries


def _clean(work: str, **options) -> Start:
    """The mediation's clean output."""

    def begin(arrived: DataFrame, **how) -> StreamingQuery:
        return start_text_sink(
            mediation_job.clean_stream(arrived, **options), f"{work}/clean", f"{work}/checkpoint/clean", **how
        )

    return begin


def _rating(work: str, clean: bool = True, **options) -> Start:
    """Rating from the clean folder, whose commit log shows it whole micro-batches, or
    from what arrives."""

    def begin(arrived: DataFrame, **how) -> StreamingQuery:
        spark = arrived.sparkSession
        values = streams.text_stream(spark, f"{work}/clean", ignore_missing_files=True) if clean else arrived
        return rating_job.start_rating(values, f"{work}/rated", f"{work}/checkpoint/rating", **how, **options)

    return begin


# Bytes of state work that a byte of records' text stands for: a record of 170 bytes takes
# about 40 microseconds of the two deduplication steps, so that a task has a second or two
# of a delivery, however few bytes the records have as columns of a compressed table.
STATE_WEIGHT = 4


def _partitions(spark: SparkSession, work: str) -> int:
    """By the text of all deliveries, those that have arrived included."""
    text = sum(folder_bytes(spark, f"{work}/{place}") for place in ("staged", "in"))
    return state_partitions(STATE_WEIGHT * text)


def _rated_rows(spark: SparkSession, path: str) -> DataFrame:
    table = table_sources.rated_events(spark, path)
    return plain_times(table.drop("writer", "batch_id", *PERIOD_COLUMNS))


def _records_arrive(spark: SparkSession, folder: str, work: str, *starts: Start) -> None:
    _deliver(spark, folder, work, staged(_ordered_wire(records(spark, folder)), work), *starts)


def _both(work: str) -> Start:
    """One mediation job with both outputs, to folders."""

    def begin(arrived: DataFrame, **how) -> list[StreamingQuery]:
        return mediation_job.start_mediation(arrived, f"{work}/clean", f"{work}/dead-letter", f"{work}/checkpoint", **how)

    return begin


@query
def stream_mediation_clean(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark)
    _records_arrive(spark, folder, work, _clean(work))
    return plain_times(mediation.parse_clean(spark.read.text(f"{work}/clean")))


@query
def stream_mediation_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    """Both outputs of one mediation job; of the dead letters every field, and
    whether their text, read again, says the same."""
    work = shared_folder(spark)
    _records_arrive(spark, folder, work, _both(work))
    letters = mediation_job.dead_letters(spark.read.text(f"{work}/dead-letter"))
    again = F.from_json("raw", RAW_CDR)
    same = [
        (fields.event_time(again[c]) if c == "timestamp" else again[c]).eqNullSafe(F.col(c))
        for c in CDR_COLUMNS
    ]
    return plain_times(
        letters.select(
            *CDR_COLUMNS,
            F.array_join("reject_reasons", ",").alias("reasons"),
            F.array_min(F.array(*same)).alias("raw_says_the_same"),
        )
    )


def _per_output(clean: DataFrame, dead: DataFrame) -> DataFrame:
    both = clean.select("record_type", F.lit("clean").alias("output")).union(
        dead.select("record_type", F.lit("dead letter"))
    )
    return both.groupBy("record_type", "output").agg(F.count("*").alias("records"))


@query
def stream_mediation_both(spark: SparkSession, folder: str) -> DataFrame:
    """One mediation job, its two outputs counted per service."""
    work = shared_folder(spark)
    _records_arrive(spark, folder, work, _both(work))
    return _per_output(
        mediation.parse_clean(spark.read.text(f"{work}/clean")),
        mediation_job.dead_letters(spark.read.text(f"{work}/dead-letter")),
    )


@query
def stream_rating(spark: SparkSession, folder: str) -> DataFrame:
    """Mediation to a clean folder and rating from it, a delivery at a time: the clean
    files of one are hash parts of the same span of time and are rated together."""
    work = shared_folder(spark)
    _records_arrive(spark, folder, work, _clean(work), _rating(work))
    return _rated_rows(spark, f"{work}/rated")


@query
def stream_rating_update_mode(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted records straight from the table, without salts, in update mode."""
    work = shared_folder(spark)
    valid = mediation.accepted(mediation.flag_valid(records(spark, folder)))
    numbers = staged(_ordered_wire(valid), work)
    _deliver(spark, folder, work, numbers, _rating(work, clean=False, salts=0, output_mode="update"))
    return _rated_rows(spark, f"{work}/rated")


@query
def stream_caller_key(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark)
    _records_arrive(spark, folder, work, _clean(work, key=dedup.CALLER_KEY))
    unique = mediation.parse_clean(spark.read.text(f"{work}/clean"))
    return plain_times(unique.select(*dedup.CALLER_KEY))


def _late_wire(spark: SparkSession, folder: str) -> DataFrame:
    """The month arrives in deliveries of eight days, a tenth of the records one
    delivery late; most of those are behind the watermark by then."""
    day = F.dayofmonth("timestamp")
    delivery = F.floor((day - 1) / 8) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    return event_log.to_wire(records(spark, folder).withColumn("delivery", delivery.cast("int")), "delivery")


@query
def stream_late_data(spark: SparkSession, folder: str) -> DataFrame:
    work = shared_folder(spark)
    _deliver(spark, folder, work, staged(_late_wire(spark, folder), work), _clean(work), idle_batches=True)
    kept = mediation.parse_clean(spark.read.text(f"{work}/clean"))
    return plain_times(
        kept.withColumn("subscriber", fields.subscriber()).select(*dedup.SUBSCRIBER_KEY)
    )


@query
def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """How many accepted records each delivery brought too late. A delivery is one
    micro-batch with rows, so one run counts all of them and its state stays where it is."""
    work = shared_folder(spark)
    numbers = staged(_late_wire(spark, folder), work)
    with counting_late_rows(spark) as late:
        (query,) = _deliver(spark, folder, work, numbers, _clean(work), idle_batches=True)
        dropped = list(zip(numbers, late.by_batch(query), strict=True))
    return spark.createDataFrame(dropped, "delivery int, late_rows bigint")


def _single_pass(work: str) -> Start:
    def begin(arrived: DataFrame, **how) -> StreamingQuery:
        return single_pass.start_single_pass(arrived, f"{work}/out", f"{work}/checkpoint", **how)

    return begin


@query
def single_pass_both(spark: SparkSession, folder: str) -> DataFrame:
    """Mediation that reads and parses its input once, its outputs counted per service."""
    work = shared_folder(spark)
    _records_arrive(spark, folder, work, _single_pass(work))
    return _per_output(
        mediation.parse_clean(single_pass.committed(spark, f"{work}/out", "clean")),
        mediation_job.dead_letters(single_pass.committed(spark, f"{work}/out", "dead-letter")),
    )


@query
def single_pass_late_data(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted record of late deliveries, once if it came in time and as often as
    it came if it was late, with the output that it went to."""
    work = shared_folder(spark)
    numbers = staged(_late_wire(spark, folder), work)
    _deliver(spark, folder, work, numbers, _single_pass(work))
    outputs = [
        mediation.parse_clean(single_pass.committed(spark, f"{work}/out", name)).withColumn("output", F.lit(name))
        for name in ("clean", "late")
    ]
    return plain_times(outputs[0].unionByName(outputs[1]).select(*CDR_COLUMNS, "output"))


@query
def single_pass_after_resizing(spark: SparkSession, folder: str) -> DataFrame:
    """Late deliveries of which the first half goes through deduplication with operator
    state in two partitions, and the rest through the single pass that takes over its
    keys and watermark: what came out of both."""
    work = shared_folder(spark)
    numbers = staged(_late_wire(spark, folder), work)
    half = len(numbers) // 2

    def in_two(arrived: DataFrame, **how) -> StreamingQuery:
        return _clean(work)(arrived, **{**how, "state_partitions": 2})

    _deliver(spark, folder, work, numbers[:half], in_two, idle_batches=True)
    single_pass.continue_from(spark, f"{work}/checkpoint/clean", f"{work}/out", f"{work}/checkpoint/new")
    _deliver(
        spark, folder, work, numbers[half:],
        lambda arrived, **how: single_pass.start_single_pass(arrived, f"{work}/out", f"{work}/checkpoint/new", **how),
    )
    both = spark.read.text(f"{work}/clean").union(single_pass.committed(spark, f"{work}/out", "clean"))
    kept = mediation.parse_clean(both)
    return plain_times(kept.withColumn("subscriber", fields.subscriber()).select(*dedup.SUBSCRIBER_KEY))


# --- sinks -----------------------------------------------------------------


@query
def idempotent_period_write(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/summary"
    summary = chains.billing_summary(records(spark, folder))
    for _ in range(2):
        table_sinks.write_summary(summary, path, GENERATED_AT)
    return plain_times(spark.read.parquet(path).select(*SUMMARY_COLUMNS, "generated_at"))


def _rebill(spark: SparkSession, work: str) -> None:
    run_to_end(
        billing_job.start_partial_rebilling(
            spark, f"{work}/rated", f"{work}/sums", f"{work}/summary", f"{work}/checkpoint"
        )
    )


@query
def incremental_rebilling(spark: SparkSession, folder: str) -> DataFrame:
    """Two halves of a month loaded, billing run after each and once more."""
    work = shared_folder(spark)
    loaded = stored_rated(spark, folder)
    day = F.dayofmonth("event_time")
    parts = [day <= 15, day > 15, None]
    for number, part in enumerate(parts):
        if part is not None:
            table_sinks.write_batch(loaded.filter(part), f"{work}/rated", "load", number)
        _rebill(spark, work)
    return spark.read.parquet(f"{work}/summary").select(*SUMMARY_COLUMNS)


@query
def rebilling_replaced_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads, of which the second has wrong prices and lacks some events; after
    its sums were merged with others' it is written again, and bills follow."""
    work = shared_folder(spark)
    loaded = stored_rated(spark, folder)
    day = F.dayofmonth("event_time")
    wrong = loaded.withColumn("cost", (F.col("cost") * 2).cast("decimal(10,4)")).filter("duration_sec % 7 != 0")
    loads = [
        (0, loaded.filter(day <= 10)),
        (1, wrong.filter((day > 10) & (day <= 20))),
        (2, loaded.filter(day > 20)),
        (1, loaded.filter((day > 10) & (day <= 20))),
    ]
    for place, (number, rows) in enumerate(loads):
        table_sinks.write_batch(rows, f"{work}/rated", "load", number)
        _rebill(spark, work)
        if place == 2:
            partials.merge_sums(spark, f"{work}/sums")
    return spark.read.parquet(f"{work}/summary").select(*SUMMARY_COLUMNS)


@query
def compacted_rated_events(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of three days each, compacted, one of them written again, more loaded,
    compacted anew, and the replaced folders deleted."""
    path = f"{shared_folder(spark)}/rated"
    loaded = stored_rated(spark, folder)
    batch = F.floor(F.dayofmonth("event_time") / 3).cast("int")

    def load(number: int, rows: DataFrame) -> None:
        table_sinks.write_batch(rows.filter(batch == number), path, "load", number)

    for number in range(6):
        # The third one lacks a service until it is written again.
        load(number, loaded if number != 2 else loaded.filter("record_type != 'sms'"))
    compaction.compact(spark, path)
    load(2, loaded)
    for number in range(6, 11):
        load(number, loaded)
    compaction.compact(spark, path)
    compaction.remove_replaced(spark, path)
    return _rated_rows(spark, path)


@query
def quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Priced records that were neither validated nor sanitized, written in three batches
    of which one is written again: the constraint report that the ledger adds up to."""
    work = shared_folder(spark)
    unchecked = rating.price(rating.to_usage(records(spark, folder)))
    unchecked.withColumn("event_id", fields.event_key()).write.parquet(f"{work}/unchecked")
    keyed = spark.read.parquet(f"{work}/unchecked")
    part = F.coalesce(F.dayofmonth("event_time") % 3, F.lit(0))
    for number in (0, 1, 2, 1):
        table_sinks.write_batch(keyed.filter(part == number), f"{work}/rated", "load", number, f"{work}/ledger")
    return quality.ledger_report(table_sinks.quality_ledger(spark, f"{work}/ledger"))


@query
def invoice_document_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = chains.billing_summary(records(spark, folder))
    path = table_sinks.write_documents(documents, f"{shared_folder(spark)}/invoices")
    layout = (
        "customer_id string, billing_period string, service string, total_events bigint, "
        "final_cost_MAD double, original_cost double, adjusted_cost double, discounted_cost double"
    )
    return spark.read.schema(layout).json(path)


# --- time ------------------------------------------------------------------


@query
def lost_by_delay(spark: SparkSession, folder: str) -> DataFrame:
    """Of accepted records that come in deliveries, a tenth of them one delivery late: how
    many each delay would lose per service, counted, and whether the merged sketches of
    all deliveries say so within their error."""
    day = F.dayofmonth("timestamp")
    delivery = F.floor((day - 1) / 8) + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    accepted = mediation.accepted(mediation.flag_valid(records(spark, folder)))
    late = lateness.late_by(accepted.withColumn("delivery", delivery.cast("int")), "record_type", "delivery", "timestamp")
    hours = (1, 24, 96, 168)
    delays = [h * 3_600_000_000 for h in hours]
    told = lateness.delay_report(lateness.sketches(late, "record_type", "delivery"), "record_type", delays)
    counted = late.groupBy("record_type").agg(
        F.count("*").alias("accepted"), *[F.count_if(F.col("late_by") >= d).alias(f"lost_{h}") for d, h in zip(delays, hours, strict=True)]
    )
    pairs = ", ".join(f"{d}L, {h}, lost_{h}" for d, h in zip(delays, hours, strict=True))
    exact = counted.selectExpr("record_type", "accepted", f"stack({len(hours)}, {pairs}) as (delay, hours, lost)")
    share = F.col("lost") / F.col("accepted")
    return exact.join(told, ["record_type", "delay"]).select(
        "record_type",
        "hours",
        "accepted",
        "lost",
        (F.abs(F.col("share_lost") - share) <= 2 * lateness.ERROR).alias("sketch_agrees"),
    )


# Rate lines with dates: one that changes, one with a gap, one that begins late, one that ends.
DATED_CARD = (
    ("voice/peak", "2024-01-01", None, "0.0150"),
    ("voice/base", "2024-01-01", "2024-01-11", "0.0100"),
    ("voice/base", "2024-01-11", None, "0.0120"),
    ("sms/flat", "2024-01-01", "2024-01-08", "0.0500"),
    ("sms/flat", "2024-01-10", "2024-01-20 12:00:00", "0.0600"),
    ("data/3G", "2024-01-05", None, "0.0800"),
    ("data/4G", "2024-01-01", "2024-01-25", "0.1000"),
    ("data/5G", "2024-01-01", None, "0.1200"),
)


def dated_card(spark: SparkSession) -> DataFrame:
    rows = [(*line, 1000.0, None) for line in DATED_CARD]
    card = spark.createDataFrame(rows, "rate_key string, begins string, ends string, rate string, threshold_mb double, none string")
    price = F.col("rate").cast("decimal(12,8)")
    return card.select(
        "rate_key",
        F.to_timestamp("begins").alias("valid_from"),
        F.to_timestamp("ends").alias("valid_to"),
        price.alias("price"),
        "threshold_mb",
        (price * F.lit(0.85).cast("decimal(3,2)")).cast("decimal(12,8)").alias("price_above"),
    )


@query
def dated_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted record, copies too, with the rate line of its time, if there is one."""
    usage = rating.to_usage(mediation.accepted(mediation.flag_valid(records(spark, folder))))
    keyed = usage.withColumn("rate_key", rating.rate_key())
    found = joins.as_of_join(keyed, dated_card(spark), ["rate_key"], "event_time")
    return plain_times(
        found.select("event_time", "user_identifier", "rate_key", "valid_from", F.col("price").cast("decimal(10,4)").alias("price"))
    )


@query
def balanced_split(spark: SparkSession, folder: str) -> DataFrame:
    """The rated events cut in eight by their duration, which is 0 for many: the rows of
    all parts, and whether none has more than twice a fair share."""
    loaded = stored_rated(spark, folder).withColumn("spread", F.xxhash64("event_id") % 1_000_000)
    conditions = table_sources.balanced_predicates(loaded, "duration_sec", 8, "spread")
    parts = loaded.agg(*[F.count_if(F.expr(c)).alias(f"p{k}") for k, c in enumerate(conditions)])
    counts = F.array(*parts.columns)
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    return parts.select(total.alias("events"), (F.array_max(counts) * 8 <= total * 2).alias("balanced"))


@query
def service_pivot_today(spark: SparkSession, folder: str) -> DataFrame:
    """The pivot with the date that it takes where none is given."""
    return billing.service_pivot(rated(spark, folder))
