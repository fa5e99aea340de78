"""Record layouts, as DDL strings usable by readers, ``from_json`` and casts."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names, order and types of a usage record on the wire.
RAW_CDR = (
    "record_type string, timestamp string, caller_id string, callee_id string, "
    "sender_id string, receiver_id string, user_id string, duration_sec int, "
    "session_duration_sec int, data_volume_mb double, cell_id string, technology string"
)
CLEAN_CDR = RAW_CDR.replace("timestamp string", "timestamp timestamp")

CDR_COLUMNS = tuple(field.split()[0] for field in RAW_CDR.split(", "))

# What pricing and billing need of a record: the only columns shuffled by them.
USAGE_COLUMNS = (
    "record_type",
    "event_time",
    "user_identifier",
    "cell_id",
    "technology",
    "duration_sec",
    "data_volume_mb",
)

RATED_COLUMNS = (
    "record_type",
    "event_time",
    "user_identifier",
    "cell_id",
    "technology",
    "cost",
    "duration_sec",
    "data_volume_mb",
    "rating_status",
)

RATED_TABLE = (
    "event_id string, record_type string, event_time timestamp, user_identifier string, "
    "cell_id string, technology string, cost decimal(10,4), duration_sec int, "
    "data_volume_mb decimal(10,2), rating_status string"
)
PERIOD_COLUMNS = ("billing_year", "billing_month")
RATED_TABLE_ON_DISK = (
    RATED_TABLE + ", writer string, batch_id bigint, billing_year int, billing_month int"
)

SUMMARY_COLUMNS = (
    "customer_id",
    "billing_year",
    "billing_month",
    "service",
    "event_count",
    "total_cost",
    "adjusted_cost",
    "discounted_cost",
    "final_cost",
)

COST = T.DecimalType(10, 4)
VOLUME = T.DecimalType(10, 2)
# Sums and bills are kept wider than the declared table columns, so that one
# very heavy subscriber gets a figure and not a NULL; operators.quality reports
# what would not fit the declared columns.
MONEY = T.DecimalType(18, 2)
