"""Literal records for the tests."""

from __future__ import annotations

import json

VOICE = {
    "record_type": "voice",
    "timestamp": "2024-01-10T09:30:00.000Z",
    "caller_id": "212600000001",
    "callee_id": "212600000002",
    "duration_sec": 60,
    "cell_id": "CELL_1",
    "technology": "4G",
}
SMS = {
    "record_type": "sms",
    "timestamp": "2024-01-10T09:30:00.000Z",
    "sender_id": "212600000001",
    "receiver_id": "212600000002",
    "cell_id": "CELL_1",
    "technology": "3G",
}
DATA = {
    "record_type": "data",
    "timestamp": "2024-01-10T09:30:00.000Z",
    "user_id": "212600000001",
    "session_duration_sec": 30,
    "data_volume_mb": 12.5,
    "cell_id": "CELL_1",
    "technology": "5G",
}


def changed(record, **fields):
    """The record with fields replaced; a field set to ... is left out."""
    return {k: v for k, v in {**record, **fields}.items() if v is not ...}


def values(spark, *records):
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(lines, "value string")
