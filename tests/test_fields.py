from datetime import datetime

import pytest
from pyspark.sql import functions as F

from samples import DATA, SMS, VOICE, changed, values
from tollbook.functions import fields
from tollbook.operators import mediation


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("2024-01-10T09:30:36.123Z", datetime(2024, 1, 10, 9, 30, 36, 123000)),
        ("2024-01-10T09:30:36.123", datetime(2024, 1, 10, 9, 30, 36, 123000)),
        ("2024-01-10T09:30:36Z", datetime(2024, 1, 10, 9, 30, 36)),
        ("2024-01-10T09:30:36", datetime(2024, 1, 10, 9, 30, 36)),
        ("2024-01-10", datetime(2024, 1, 10)),
        ("2024-01-10 09:30:36", None),
        ("2024-01-10T09:30:36+01:00", None),
        ("INVALID", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time_shapes(spark, text, expected):
    row = spark.createDataFrame([(text,)], "t string").select(
        fields.event_time(F.col("t")).cast("timestamp_ntz").alias("t")
    )
    assert row.first().t == expected


def test_a_wrong_type_loses_only_its_field(spark):
    rows = mediation.parse_raw(
        values(
            spark,
            changed(VOICE, duration_sec="INVALID"),
            changed(VOICE, duration_sec="5"),
            changed(VOICE, duration_sec=5.5),
            changed(VOICE, cell_id=17),
            "not json",
        )
    ).collect()
    assert [r.duration_sec for r in rows] == [None, None, None, 60, None]
    assert [r.cell_id for r in rows] == ["CELL_1"] * 3 + ["17", None]
    assert [r.record_type for r in rows] == ["voice"] * 4 + [None]
    assert rows[4].raw == "not json"


def test_values_leave_nulls_out_and_read_back(spark):
    records = mediation.type_event_time(mediation.parse_raw(values(spark, VOICE, SMS, DATA)))
    clean = records.drop("raw")
    text = mediation.to_values(clean)
    assert "sender_id" not in text.first().value
    assert mediation.parse_clean(text).collect() == clean.collect()


def test_subscriber_is_the_paying_party(spark):
    rows = mediation.parse_raw(values(spark, VOICE, SMS, DATA)).select(fields.subscriber())
    assert {r[0] for r in rows.collect()} == {"212600000001"}


def test_digest_keeps_parts_apart(spark):
    rows = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), ("", "abc"), (None, "abc"), ("abc", None)], "x string, y string"
    )
    keys = rows.select(fields.digest(F.col("x"), F.col("y"))).collect()
    assert len({k[0] for k in keys}) == 5


def test_period_label(spark):
    row = spark.range(1).select(fields.period_label(F.lit(2024), F.lit(3))).first()
    assert row[0] == "2024-03"
