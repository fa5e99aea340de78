import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from samples import DATA, SMS, VOICE, changed, values
from tollbook.operators import invoicing, mediation, quality
from tollbook.schemas import RATED_TABLE

START = datetime(2024, 1, 1)


def late_by_brute_force(rows):
    late = set()
    for owner, arrival, time in rows:
        if any(o == owner and a < arrival and t > time for o, a, t in rows):
            late.add((owner, arrival))
    return late


@pytest.mark.parametrize("blocks", [1, 3, 60, None])
def test_out_of_order_matches_brute_force(spark, blocks):
    rng = random.Random(blocks or 0)
    rows = [
        # one owner with most of the rows, arrivals numbered by partition and row
        ("hot" if rng.random() < 0.6 else f"u{rng.randrange(4)}", (n // 40 << 33) + n * 3, START + timedelta(
            seconds=n + rng.choice([0, 0, 0, -40, 15])))
        for n in range(300)
    ]
    rows += rows[100:103] * 40
    frame = spark.createDataFrame(rows, "who string, n bigint, t timestamp")
    flagged = quality.out_of_order(frame, F.col("who"), "n", F.col("t"), blocks)
    assert flagged.agg(F.sum("copies")).first()[0] == len(rows)
    assert flagged.count() == 300
    got = {(r.owner, r.arrival) for r in flagged.filter("late").collect()}
    assert got == late_by_brute_force(rows)


def test_out_of_order_of_nothing(spark):
    empty = spark.createDataFrame([], "who string, n bigint, t timestamp")
    assert quality.out_of_order(empty, F.col("who"), "n", F.col("t")).isEmpty()


def test_a_field_that_is_there_but_unreadable_is_not_missing(spark):
    """A record may lack one field and have another of the wrong type."""
    record = changed(VOICE, duration_sec=-5, cell_id=...)
    typed = mediation.type_event_time(mediation.parse_raw(values(spark, record)))
    frame = typed.withColumn("n", F.lit(1).cast("bigint"))
    for raw in (None, "raw"):
        report = {r.anomaly: r.records for r in quality.anomaly_report(frame, "n", raw).collect()}
        assert report["missing_field"] == 1 and report["corrupt_value"] == 1


def test_each_anomaly_is_counted(spark):
    records = [
        VOICE,
        SMS,
        DATA,
        changed(VOICE, duration_sec=...),
        changed(SMS, receiver_id=...),
        changed(VOICE, duration_sec=-60, timestamp="2024-01-11T00:00:00Z"),
        changed(DATA, session_duration_sec="INVALID", timestamp="2024-01-11T00:00:01Z"),
        changed(VOICE, timestamp="INVALID"),
        changed(VOICE, cell_id="INVALID", timestamp="2024-01-11T00:00:02Z"),
        changed(VOICE, record_type="mms", technology="INVALID_TECH"),
        changed(SMS, timestamp="2024-01-12T00:00:00Z"),
        changed(SMS, timestamp="2023-12-20T00:00:00Z"),
        changed(SMS, timestamp="2024-01-12T00:00:00Z"),
    ]
    parsed = [
        mediation.type_event_time(mediation.parse_raw(values(spark, r))).withColumn(
            "n", F.lit(i).cast("bigint")
        )
        for i, r in enumerate(records)
    ]
    frame = parsed[0]
    for other in parsed[1:]:
        frame = frame.union(other)
    report = {r.anomaly: r.records for r in quality.anomaly_report(frame, "n", "raw").collect()}
    # the copies share their key with an earlier record; two records come after
    # a later one of the same subscriber: the unknown service and December's
    assert report == {
        "missing_field": 2,
        "corrupt_value": 4,
        "invalid_service": 1,
        "duplicate": 3,
        "out_of_order": 2,
    }


def table(spark, *changes):
    good = {
        "event_id": "id",
        "record_type": "voice",
        "event_time": START,
        "user_identifier": "212600000001",
        "cell_id": "CELL_1",
        "technology": "4G",
        "cost": Decimal("1.0"),
        "duration_sec": 60,
        "data_volume_mb": Decimal("0"),
        "rating_status": "rated",
    }
    rows = [tuple({**good, "event_id": f"id{i}", **c}.values()) for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, RATED_TABLE)


def test_constraint_report_counts_each_rule(spark):
    rows = table(
        spark,
        {},
        {"record_type": None},
        {"record_type": "telegraph-line"},
        {"cost": Decimal("-1")},
        {"cost": None},
        {"user_identifier": "1" * 16},
        {"technology": "INVALID_TECH"},
        {"event_id": "same"},
        {"event_id": "same"},
        {"event_id": "same"},
    )
    report = {
        r.rule: r.violations
        for r in quality.constraint_report(rows, "rated_events").collect()
        if r.violations
    }
    assert report == {
        "record_type not null": 1,
        "record_type at most 10 characters": 1,
        "record_type in service list": 1,
        "cost not negative": 1,
        "cost not null": 1,
        "user_identifier at most 15 characters": 1,
        "technology at most 5 characters": 1,
        "primary key unique": 2,
    }


def test_invoice_totals_beyond_the_declared_column_are_reported(spark):
    rows = table(spark, *[{"cost": Decimal("999999")}] * 3)
    headers = invoicing.invoice_headers(rows)
    assert headers.first().total_cost == Decimal("2999997.0000")
    report = quality.constraint_report(headers, "invoices").filter("violations > 0").collect()
    assert [r.rule for r in report] == ["total_cost fits its column"]


def test_orphans_are_found_and_weighted(spark):
    events = table(spark, {}, {}, {})
    invoices = invoicing.invoice_headers(events)
    items = invoicing.line_items(events)
    clean = quality.referential_report(items, invoices, events).collect()
    assert [(r.missing_keys, r.orphan_items) for r in clean] == [(0, 0), (0, 0)]
    lost = items.union(spark.createDataFrame([("gone", "id0"), ("gone", "id9")], items.schema))
    report = {
        r.reference: (r.missing_keys, r.orphan_items)
        for r in quality.referential_report(lost, invoices, events).collect()
    }
    assert report == {"invoice": (1, 2), "event": (1, 1)}


def test_reason_counts_cover_every_rejected_record(spark):
    flagged = mediation.mediate(
        values(spark, VOICE, changed(VOICE, cell_id=...), changed(SMS, cell_id=...), "junk")
    )
    counts = quality.reason_counts(flagged).filter("reason = 'cell_missing'")
    assert sum(r.records for r in counts.collect()) == 3
