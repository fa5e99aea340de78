import json
from datetime import datetime, timedelta

import compare
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from samples import SMS, VOICE, changed, values
from tollbook.operators import dedup, mediation
from tollbook.plans import catalogue, oracle
from tollbook.session import folder_bytes, shared_folder, shuffle_partitions, state_partitions
from tollbook.sinks.streams import start_batch_sink, start_text_sink
from tollbook.sources import streams, tables
from tollbook.streaming import mediation as mediation_job
from tollbook.streaming import rating as rating_job
from tollbook.streaming.lifecycle import counting_late_rows, run_forever, run_to_end

NOON = datetime(2024, 1, 10, 12)


def call(minute, caller="212600000001", **fields):
    time = (NOON + timedelta(minutes=minute)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return changed(VOICE, timestamp=time, caller_id=caller, **fields)


def deliver(spark, folder, *records):
    values(spark, *records).coalesce(1).write.mode("append").text(str(folder))


def mediate(spark, work, **options):
    queries = mediation_job.start_mediation(
        streams.text_stream(spark, f"{work}/in"),
        f"{work}/clean",
        f"{work}/dead",
        f"{work}/checkpoint",
        once=True,
        **options,
    )
    run_to_end(*queries)
    return queries


def late_rows(spark, work, **options):
    """Runs the mediation and counts what its clean output dropped."""
    with counting_late_rows(spark) as late:
        clean, _ = mediate(spark, work, **options)
        return late.of(clean)


def minutes(spark, work):
    clean = mediation.parse_clean(spark.read.text(f"{work}/clean"))
    return sorted(
        int((t.timestamp - NOON).total_seconds() // 60)
        for t in clean.select(F.col("timestamp").cast("timestamp_ntz").alias("timestamp")).collect()
    )


@pytest.mark.parametrize("salts", [0, 3])
def test_late_records_are_dropped_and_counted(spark, tmp_path, salts):
    deliver(spark, tmp_path / "in", call(0), call(0), call(-60))
    assert late_rows(spark, tmp_path, salts=salts) == 0 and minutes(spark, tmp_path) == [-60, 0]
    deliver(spark, tmp_path / "in", call(-60), call(-3), call(0), call(30))
    assert late_rows(spark, tmp_path, salts=salts) == 1 and minutes(spark, tmp_path) == [-60, -3, 0, 30]
    deliver(spark, tmp_path / "in", call(24), call(26), call(30))
    assert late_rows(spark, tmp_path, salts=salts) == 1 and minutes(spark, tmp_path) == [-60, -3, 0, 26, 30]


def test_a_longer_delay_keeps_more(spark, tmp_path):
    for batch in ([call(0)], [call(-60)], [call(-61)]):
        deliver(spark, tmp_path / "in", *batch)
        mediate(spark, tmp_path, delay="2 hours")
    assert minutes(spark, tmp_path) == [-61, -60, 0]


def test_a_restart_without_news_emits_nothing(spark, tmp_path):
    deliver(spark, tmp_path / "in", call(0), call(1), "not json")
    mediate(spark, tmp_path)
    mediate(spark, tmp_path)
    assert minutes(spark, tmp_path) == [0, 1]
    assert spark.read.text(f"{tmp_path}/dead").count() == 1


def test_dead_letters_keep_text_and_reasons(spark, tmp_path):
    deliver(spark, tmp_path / "in", "not json", call(0, duration_sec=-1), call(0))
    mediate(spark, tmp_path)
    letters = mediation_job.dead_letters(spark.read.text(f"{tmp_path}/dead")).collect()
    by_type = {r.record_type: r for r in letters}
    assert by_type[None].raw == "not json"
    assert by_type["voice"].reject_reasons == ["duration_not_positive"]
    assert json.loads(by_type["voice"].raw)["duration_sec"] == -1


def test_bare_dead_letters_hold_only_what_was_read(spark):
    lost = mediation_job.dead_letter_stream(values(spark, "not json"), with_raw=False)
    assert lost.first().value == '{"is_valid":false}'


def test_caller_key_merges_messages(spark, tmp_path):
    deliver(spark, tmp_path / "in", SMS, changed(SMS, sender_id="212600000009"), VOICE)
    mediate(spark, tmp_path, key=dedup.CALLER_KEY)
    assert len(minutes(spark, tmp_path)) == 2


@pytest.mark.parametrize(("salts", "mode"), [(0, "update"), (0, "append"), (5, "append")])
def test_rating_gives_the_same_table_in_every_mode(spark, tmp_path, salts, mode):
    records = [call(0), call(0), call(1), call(1, technology="2G", duration_sec=7)]
    deliver(spark, tmp_path / "in", *records)
    mediate(spark, tmp_path)
    run_to_end(
        rating_job.start_rating(
            streams.text_stream(spark, f"{tmp_path}/clean", ignore_missing_files=True),
            f"{tmp_path}/rated",
            f"{tmp_path}/checkpoint/rating",
            salts=salts,
            output_mode=mode,
            once=True,
            report_path=f"{tmp_path}/report",
        )
    )
    rows = tables.rated_events(spark, f"{tmp_path}/rated").collect()
    assert len({r.event_id for r in rows}) == len(rows) == 2
    report = spark.read.parquet(f"{tmp_path}/report").first()
    assert (report.read_rows, report.loaded_rows) == (2, 2)


def test_micro_batches_and_one_batch_agree(spark, tmp_path):
    """Ordered deliveries, a file per micro-batch, no late records."""
    for minute in range(0, 30, 3):
        deliver(spark, tmp_path / "in", *[call(minute + n % 3) for n in range(6)])
    query = start_text_sink(
        mediation_job.clean_stream(
            streams.text_stream(spark, f"{tmp_path}/in", max_files_per_trigger=4), delay="1 hour"
        ),
        f"{tmp_path}/clean",
        f"{tmp_path}/checkpoint",
        once=True,
        state_partitions=3,
    )
    run_to_end(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) >= 2
    assert minutes(spark, tmp_path) == list(range(30))


def test_state_partitions_leave_the_session_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    deliver(spark, tmp_path / "in", call(0))
    mediate(spark, tmp_path, state_partitions=2)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_partition_sizing(spark, tmp_path):
    assert shuffle_partitions(0, 4) == 4
    assert shuffle_partitions(100 << 40, 4000) == 820000
    deliver(spark, tmp_path / "in", call(0))
    assert folder_bytes(spark, f"{tmp_path}/in") > 0
    assert state_partitions(0) == 1 and state_partitions(10 << 40) == 81920


def test_late_rows_are_counted_beyond_the_reports_a_query_keeps(spark, tmp_path):
    """One report is kept; the rows of all micro-batches are counted."""
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, 1)
    try:
        deliver(spark, tmp_path / "in", call(600))
        mediate(spark, tmp_path)
        for minute in range(4):
            deliver(spark, tmp_path / "in", call(minute))
        with counting_late_rows(spark) as late:
            query = start_text_sink(
                mediation_job.clean_stream(streams.text_stream(spark, f"{tmp_path}/in", 1)),
                f"{tmp_path}/clean",
                f"{tmp_path}/checkpoint/clean",
                once=True,
            )
            run_to_end(query)
            assert late.of(query) == 4 and len(query.recentProgress) < 4
    finally:
        spark.conf.unset(key)


def test_state_is_evicted_as_the_stream_goes(spark, monkeypatch):
    """Ten deliveries in the order of their times hold far fewer keys than there are."""
    folder = "/root/testdata/sf0.001"
    work = shared_folder(spark)
    monkeypatch.setattr(catalogue, "DELIVERIES", 10)
    numbers = catalogue.staged(catalogue._ordered_wire(catalogue.records(spark, folder)), work)
    (query,) = catalogue._deliver(spark, folder, work, numbers, catalogue._clean(work, salts=0), idle_batches=True)
    batches = [p for p in query.recentProgress if p["numInputRows"]]
    peak = max(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])
    distinct = spark.read.text(f"{work}/clean").count()
    assert len(batches) == 10 and peak < distinct / 4


def test_rating_takes_all_files_of_a_mediated_delivery(spark, monkeypatch):
    """Three state partitions make three clean files of each delivery; rated one by
    one, the first would make the others late."""
    folder = "/root/testdata/sf0.001"
    monkeypatch.setattr(catalogue, "state_partitions", lambda size: 3)
    expected = compare.sql_result(compare.connect(folder), oracle.SQL["stream_rating"])
    assert compare.spark_result(catalogue.stream_rating(spark, folder)) == expected


def test_state_is_sized_by_the_records_text(spark, tmp_path, monkeypatch):
    """Columns of a table take a fraction of what the records in them take as state."""
    folder, sizes = "/root/testdata/sf0.001", []
    monkeypatch.setattr(catalogue, "shared_folder", lambda spark: f"{tmp_path}/work")
    monkeypatch.setattr(catalogue, "state_partitions", lambda size: sizes.append(size) or 3)
    found = compare.spark_result(catalogue.stream_mediation_clean(spark, folder))
    assert found == compare.sql_result(compare.connect(folder), oracle.SQL["stream_mediation_clean"])
    text = folder_bytes(spark, f"{tmp_path}/work/in")
    assert text > 2 * folder_bytes(spark, f"{folder}/events.parquet") and min(sizes) >= text


@pytest.mark.parametrize("name", ["stream_mediation_clean", "stream_late_rows"])
def test_a_delivery_is_written_by_many_tasks(spark, tmp_path, monkeypatch, name):
    """Deliveries of several files each, from a table of several files, and no row is
    lost or late for that."""
    folder = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{folder}/events.parquet")
    events.repartition(3).write.parquet(f"{tmp_path}/tables/events.parquet")
    monkeypatch.setattr(catalogue, "shared_folder", lambda spark: f"{tmp_path}/work")
    small = {"spark.sql.files.maxPartitionBytes": 8192, "spark.sql.files.openCostInBytes": 8192}
    before = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        found = compare.spark_result(catalogue.QUERIES[name](spark, f"{tmp_path}/tables"))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert found == compare.sql_result(compare.connect(folder), oracle.SQL[name])
    deliveries = len(list((tmp_path / "work" / "in").glob("[0-9]*")))
    assert deliveries >= 4 and len(list((tmp_path / "work" / "in").glob("*/part-*"))) >= 2 * deliveries


def test_late_rows_of_all_deliveries_are_counted_in_one_run(spark, monkeypatch):
    """A run each would load all state again for every delivery."""
    folder, started = "/root/testdata/sf0.001", []

    def start(*args, **how):
        started.append(start_text_sink(*args, **how))
        return started[-1]

    monkeypatch.setattr(catalogue, "start_text_sink", start)
    found = compare.spark_result(catalogue.stream_late_rows(spark, folder))
    assert found == compare.sql_result(compare.connect(folder), oracle.SQL["stream_late_rows"])
    assert len(started) == 1


def test_the_first_failure_ends_all(spark, tmp_path):
    """A failing query beside one that never ends."""
    deliver(spark, tmp_path / "in", call(0))

    def fail(batch, number):
        raise RuntimeError("no table")

    endless = start_text_sink(
        streams.text_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/a", f"{tmp_path}/ca"
    )
    failing = start_batch_sink(streams.text_stream(spark, f"{tmp_path}/in"), fail, f"{tmp_path}/cb", once=True)
    with pytest.raises(StreamingQueryException):
        run_to_end(endless, failing)
    assert not endless.isActive
    spark.streams.resetTerminated()


def test_run_forever_ends_with_the_first_query(spark, tmp_path):
    deliver(spark, tmp_path / "in", call(0))
    endless = start_text_sink(
        streams.text_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/a", f"{tmp_path}/ca"
    )
    start_text_sink(
        streams.text_stream(spark, f"{tmp_path}/in"),
        f"{tmp_path}/b",
        f"{tmp_path}/cb",
        once=True,
    )
    run_forever(spark)
    assert not endless.isActive and not spark.streams.active
    spark.streams.resetTerminated()


def test_topic_options():
    options = streams.topic_options("broker:9092", "clean", False, 1000, 64)
    assert options == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "clean",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }


def test_stream_path_accepts_a_file_and_a_folder():
    assert streams.stream_path("/data/events.parquet") == "/data/events.parque[t]"
    assert streams.stream_path("/data/events/") == "/data/event[s]"
