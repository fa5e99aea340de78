"""Usage records derived from a generic event table.

``events(event_id, ts, user_id, event_type, value, ...)`` holds no calls or
messages; the mapping gives each event the shape of a usage record, with
missing fields, corrupt values, copies and unknown services at fixed places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the mapping.
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
SERVICE_OF_EVENT = {
    "click": "voice",
    "view": "voice",
    "purchase": "data",
    "signup": "sms",
    "error": "fax",
}
TECHNOLOGY_CYCLE = ("2G", "3G", "4G", "5G", "LTE")
OTHER_PARTY = "212600000000"
WIRE_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def to_records(events: DataFrame) -> DataFrame:
    """Typed usage records in wire order, followed by ``event_id``.

    Every fiftieth event appears twice.
    """
    service = F.create_map(
        *[F.lit(x) for pair in SERVICE_OF_EVENT.items() for x in pair]
    )[F.col("event_type")]
    number = F.col("event_id")
    kind = F.col("record_type")
    call = kind.isin("voice", "fax")
    user = F.concat(F.lit("2126"), F.lpad(F.col("user_id").cast("string"), 8, "0"))
    other = F.lit(OTHER_PARTY)
    seconds = F.floor(F.col("value") * 5).cast("int")
    seconds = F.when(number % 89 == 0, -seconds).otherwise(seconds)
    megabytes = F.round(F.col("value") * 20, 2).cast("decimal(10,2)").cast("double")
    technology = F.when(kind == "fax", F.lit("INVALID_TECH")).otherwise(
        F.get(F.array(*[F.lit(t) for t in TECHNOLOGY_CYCLE]), (number % 5).cast("int"))
    )
    copies = F.when(number % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        events.select(*EVENT_COLUMNS, service.alias("record_type"))
        .withColumn("copy", F.explode(copies))
        .select(
            "record_type",
            F.date_trunc("second", F.col("ts").cast("timestamp")).alias("timestamp"),
            F.when(call, user).alias("caller_id"),
            F.when(call, other).alias("callee_id"),
            F.when(kind == "sms", user).alias("sender_id"),
            F.when(kind == "sms", other).alias("receiver_id"),
            F.when(kind == "data", user).alias("user_id"),
            F.when(call, seconds).alias("duration_sec"),
            F.when(kind == "data", seconds).alias("session_duration_sec"),
            F.when(kind == "data", megabytes).alias("data_volume_mb"),
            F.when(number % 97 != 0, F.concat(F.lit("CELL_"), (number % 50 + 1).cast("string"))).alias(
                "cell_id"
            ),
            technology.alias("technology"),
            "event_id",
        )
    )


def to_wire(records: DataFrame, *beside: str) -> DataFrame:
    """The records as JSON text, the way they arrive on a stream; columns named in
    ``beside`` stay columns."""
    text = records.withColumn("timestamp", F.date_format("timestamp", WIRE_TIME))
    fields = [c for c in text.columns if c not in ("event_id", *beside)]
    return text.select(F.to_json(F.struct(*fields)).alias("value"), *beside)
