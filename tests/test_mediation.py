import pytest
from pyspark.sql import functions as F

from samples import DATA, SMS, VOICE, changed, values
from tollbook.operators import mediation

GOOD = [
    VOICE,
    SMS,
    DATA,
    changed(VOICE, cell_id="INVALID"),
    changed(VOICE, caller_id="INVALID"),
    changed(SMS, technology="LTE"),
    changed(DATA, technology="2G"),
    changed(VOICE, timestamp="2024-01-10"),
]
BAD = {
    "duration_not_positive": [
        changed(VOICE, duration_sec=...),
        changed(VOICE, duration_sec=-60),
        changed(VOICE, duration_sec=0),
        changed(VOICE, duration_sec="INVALID"),
    ],
    "timestamp_missing": [
        changed(VOICE, timestamp="INVALID"),
        changed(VOICE, timestamp=...),
    ],
    "cell_missing": [changed(SMS, cell_id=...)],
    "technology_missing,technology_unknown": [changed(SMS, technology=...)],
    "caller_missing": [changed(VOICE, caller_id=...)],
    "callee_missing": [changed(VOICE, callee_id=None)],
    "sender_missing": [changed(SMS, sender_id=...)],
    "receiver_missing": [changed(SMS, receiver_id=...)],
    "user_missing": [changed(DATA, user_id=...)],
    "volume_not_positive": [changed(DATA, data_volume_mb=-1.5), changed(DATA, data_volume_mb=...)],
    "session_not_positive": [changed(DATA, session_duration_sec="INVALID")],
    "service_unknown,technology_unknown": [
        changed(VOICE, record_type="mms", technology="INVALID_TECH")
    ],
    "service_unknown": [changed(VOICE, record_type=None), changed(VOICE, record_type=...)],
    "service_unknown,timestamp_missing,cell_missing,technology_missing,technology_unknown": [
        "not json",
        "{}",
    ],
}


@pytest.mark.parametrize("record", GOOD)
def test_accepted(spark, record):
    row = mediation.with_reasons(mediation.mediate(values(spark, record))).first()
    assert row.is_valid and row.reject_reasons == []


@pytest.mark.parametrize("reasons", BAD)
def test_rejected_with_reasons(spark, reasons):
    rows = mediation.with_reasons(mediation.mediate(values(spark, *BAD[reasons]))).collect()
    assert [r.is_valid for r in rows] == [False] * len(rows)
    assert [",".join(r.reject_reasons) for r in rows] == [reasons] * len(rows)


def test_every_record_is_in_exactly_one_branch(spark):
    everything = GOOD + [r for rs in BAD.values() for r in rs]
    flagged = mediation.mediate(values(spark, *everything))
    assert mediation.accepted(flagged).count() == len(GOOD)
    assert mediation.rejected(flagged).count() == len(everything) - len(GOOD)


def test_unknown_service_can_stay_undecided(spark):
    parsed = mediation.type_event_time(
        mediation.parse_raw(values(spark, changed(VOICE, record_type=None)))
    )
    flagged = mediation.flag_valid(parsed, keep_unknown=True)
    assert flagged.first().is_valid is None
    assert mediation.accepted(flagged).isEmpty() and mediation.rejected(flagged).isEmpty()


def test_technology_per_service_is_an_option(spark):
    rows = mediation.mediate(
        values(spark, changed(SMS, technology="5G"), changed(DATA, technology="2G"), VOICE),
        per_service_technology=True,
    )
    assert [r.is_valid for r in rows.collect()] == [False, False, True]


def test_clean_records_have_the_wire_columns(spark):
    clean = mediation.clean_records(mediation.mediate(values(spark, VOICE)))
    assert "is_valid" not in clean.columns and "raw" not in clean.columns
    assert clean.schema["timestamp"].dataType.typeName() == "timestamp"


def test_flag_and_reasons_agree_on_every_combination(spark):
    """All subsets of nulled fields, for every service."""
    columns = [c for c in DATA | SMS | VOICE]
    rows = []
    for base in (VOICE, SMS, DATA):
        for bits in range(1 << len(base)):
            rows.append({k: v for i, (k, v) in enumerate(base.items()) if bits >> i & 1})
    flagged = mediation.with_reasons(mediation.mediate(values(spark, *rows)))
    wrong = flagged.filter(F.col("is_valid") != (F.size("reject_reasons") == 0))
    assert wrong.isEmpty() and len(columns) == 12
