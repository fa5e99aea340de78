"""Reports on rejected records, declared constraints and anomalies."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tollbook.functions import fields, validity
from tollbook.operators import dedup
from tollbook.schemas import COST, VOLUME
from tollbook.session import shared_folder
from tollbook.tariff import SERVICES

# The declared widths of text columns.
TEXT_LIMITS = {
    "rated_events": {"record_type": 10, "user_identifier": 15, "cell_id": 50, "technology": 5},
    "invoices": {"user_id": 15},
}
REQUIRED = {
    "rated_events": (
        "event_id",
        "record_type",
        "event_time",
        "user_identifier",
        "cell_id",
        "technology",
        "cost",
    ),
    "invoices": (
        "invoice_id",
        "user_id",
        "billing_period_start",
        "billing_period_end",
        "total_cost",
        "paid",
    ),
    "invoice_line_items": ("invoice_id", "event_id"),
}
PRIMARY_KEY = {
    "rated_events": ("event_id",),
    "invoices": ("invoice_id",),
    "invoice_line_items": ("invoice_id", "event_id"),
}


def reason_counts(flagged: DataFrame, per_service_technology: bool = False) -> DataFrame:
    """Rejected records per service and failed rule."""
    return (
        flagged.filter(~F.col("is_valid"))
        .select(
            "record_type",
            F.explode(validity.reject_reasons(per_service_technology)).alias("reason"),
        )
        .groupBy("record_type", "reason")
        .agg(F.count("*").alias("records"))
    )


def _long(counts: dict[str, Column], rows: DataFrame, name: str, value: str) -> DataFrame:
    """One aggregation over the rows, turned into (name, value) lines."""
    labels = list(counts)
    wide = rows.agg(*[counts[label].alias(f"c{i}") for i, label in enumerate(labels)])
    pairs = ", ".join(f"'{label}', c{i}" for i, label in enumerate(labels))
    return wide.selectExpr(f"stack({len(labels)}, {pairs}) as ({name}, {value})")


def _fits(column: str, decimal_type) -> Column:
    return F.col(column).isNull() | F.col(column).try_cast(decimal_type).isNotNull()


def row_rules(table: str) -> dict[str, Column]:
    """The declared constraints that a row alone can break, and when it does."""
    broken: dict[str, Column] = {
        f"{c} not null": F.col(c).isNull() for c in REQUIRED[table]
    }
    for column, limit in TEXT_LIMITS.get(table, {}).items():
        broken[f"{column} at most {limit} characters"] = F.length(column) > limit
    if table == "rated_events":
        broken["record_type in service list"] = ~F.col("record_type").isin(*SERVICES)
        broken["cost not negative"] = F.col("cost") < 0
        broken["data_volume_mb fits its column"] = ~_fits("data_volume_mb", VOLUME)
    if table == "invoices":
        broken["total_cost not negative"] = F.col("total_cost") < 0
        broken["total_cost fits its column"] = ~_fits("total_cost", COST)
    return broken


def constraint_report(rows: DataFrame, table: str) -> DataFrame:
    """Violations of each declared constraint of a table, zero lines included."""
    counts = {rule: F.count_if(condition) for rule, condition in row_rules(table).items()}
    surplus = dedup.repeated(rows, PRIMARY_KEY[table]).agg(
        F.coalesce(F.sum("surplus"), F.lit(0)).cast("bigint").alias("violations")
    )
    report = _long(counts, rows, "rule", "violations").unionByName(
        surplus.withColumn("rule", F.lit("primary key unique"))
    )
    return report.select(F.lit(table).alias("table_name"), "rule", "violations")


def counted_on_the_way(rows: DataFrame, table: str) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """The rows, and the violations of each constraint that a row alone can break, which
    are counted by whatever writes the rows; ask for them when that is done."""
    rules = row_rules(table)
    told = Observation()
    watched = rows.observe(told, *[F.count_if(broken).alias(f"c{k}") for k, broken in enumerate(rules.values())])
    return watched, lambda: {rule: told.get[f"c{k}"] for k, rule in enumerate(rules)}


def ledger_report(ledger: DataFrame) -> DataFrame:
    """The constraint report of all batches in a quality ledger, without a look at them."""
    return ledger.groupBy("table_name", "rule").agg(F.sum("violations").alias("violations"))


def orphans(items: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Keys without a parent row, with the number of items pointing at them.

    Items are counted per key before the join, so a parent with very many
    items does not weigh on one task.
    """
    return items.groupBy(key).agg(F.count("*").alias("items")).join(
        parents.select(key), key, "left_anti"
    )


def referential_report(items: DataFrame, invoices: DataFrame, events: DataFrame) -> DataFrame:
    """Line items whose invoice or event does not exist."""

    def line(label: str, parents: DataFrame, key: str) -> DataFrame:
        return orphans(items, parents, key).agg(
            F.lit(label).alias("reference"),
            F.count("*").alias("missing_keys"),
            F.coalesce(F.sum("items"), F.lit(0)).cast("bigint").alias("orphan_items"),
        )

    return line("invoice", invoices, "invoice_id").unionByName(line("event", events, "event_id"))


def out_of_order(
    rows: DataFrame, owner: Column, arrival: str, time: Column, blocks: int | None = None
) -> DataFrame:
    """Distinct (owner, arrival, time) with the number of their ``copies`` and
    ``late``: an earlier arrival of the same owner carries a later time.

    A running maximum per owner, cut into ranges of owner and arrival that hold
    about as many rows each, whatever numbers the arrivals have: an owner with very
    many rows is spread over ranges, and each starts from the maximum of the owner's
    ranges before it. There are as many ranges as shuffle partitions, or ``blocks``.
    Copies are counted before that, and the ranges are stored, as drawing them
    again could draw them elsewhere.
    """
    narrow = rows.select(
        owner.alias("owner"), F.col(arrival).alias("arrival"), time.alias("time")
    ).filter("owner is not null and arrival is not null and time is not null")
    distinct = narrow.groupBy(*narrow.columns).agg(F.count("*").alias("copies"))
    ranged = distinct.repartitionByRange(*([blocks] if blocks else []), "owner", "arrival")
    path = f"{shared_folder(rows.sparkSession)}/ranges"
    placed = ranged.withColumn("block", F.spark_partition_id())
    placed.write.parquet(path)
    placed = rows.sparkSession.read.schema(placed.schema).parquet(path)
    before = Window.partitionBy("owner").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # At most one row per owner and range, whatever the rows.
    carried = (
        placed.groupBy("owner", "block")
        .agg(F.max("time").alias("block_max"))
        .select("owner", "block", F.max("block_max").over(before).alias("carried"))
    )
    running = (
        Window.partitionBy("owner", "block")
        .orderBy("arrival", "time")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # The window comes before the join, which then finds its rows already
    # distributed and sorted.
    within = placed.withColumn("running", F.max("time").over(running))
    return within.join(carried, ["owner", "block"]).select(
        "owner",
        "arrival",
        "time",
        "copies",
        (F.col("time") < F.greatest("running", "carried")).alias("late"),
    )


def _any(conditions: list[Column]) -> Column:
    return reduce(or_, [F.coalesce(c, F.lit(False)) for c in conditions])


def _present(raw: Column) -> Column:
    """The fields that a record's text has, whatever their types."""
    return F.from_json(raw, "map<string,string>")


def _missing(raw: str | None) -> Column:
    """A field its service needs is absent; where the raw text is at hand, one that
    is there but unreadable is not absent."""

    def absent(column: str) -> Column:
        if not raw:
            return F.col(column).isNull()
        return F.col(column).isNull() & _present(F.col(raw))[column].isNull()

    checks = [absent(c) for c in validity.ALWAYS_REQUIRED]
    for service, columns in validity.SERVICE_REQUIRED.items():
        checks += [(F.col("record_type") == service) & absent(c) for c in columns]
    return _any(checks)


IDENTIFIERS = (
    "caller_id",
    "callee_id",
    "sender_id",
    "receiver_id",
    "user_id",
    "cell_id",
    "technology",
)
INVALID_TEXT = "INVALID"


def wrong_type(raw: Column) -> Column:
    """A field is present in the raw text but could not be read as its type."""
    present = _present(raw)
    checked = (*validity.QUANTITIES, "timestamp")
    return _any([present[c].isNotNull() & F.col(c).isNull() for c in checked])


def _corrupt(raw: str | None) -> Column:
    """A negative quantity, the text the source writes over a bad value, or,
    where the raw text is at hand, a field of the wrong type."""
    checks = [F.col(c) < 0 for c in validity.QUANTITIES]
    checks += [F.col(c) == INVALID_TEXT for c in IDENTIFIERS]
    if raw:
        checks.append(wrong_type(F.col(raw)))
    return _any(checks)


def anomaly_report(
    records: DataFrame,
    arrival: str,
    raw: str | None = None,
    key: Sequence[str] = dedup.SUBSCRIBER_KEY,
) -> DataFrame:
    """Number of records per anomaly kind; a record may count for several.

    ``arrival`` numbers the records in the order they came in.
    """
    counts = {
        "missing_field": F.count_if(_missing(raw)),
        "corrupt_value": F.count_if(_corrupt(raw)),
        "invalid_service": F.count_if(
            ~F.coalesce(F.col("record_type").isin(*SERVICES), F.lit(True))
        ),
    }
    surplus = dedup.repeated(records, key).agg(
        F.lit("duplicate").alias("anomaly"),
        F.coalesce(F.sum("surplus"), F.lit(0)).cast("bigint").alias("records"),
    )
    late = out_of_order(records, fields.subscriber(), arrival, F.col("timestamp")).agg(
        F.lit("out_of_order").alias("anomaly"),
        F.coalesce(F.sum(F.when(F.col("late"), F.col("copies"))), F.lit(0))
        .cast("bigint")
        .alias("records"),
    )
    return _long(counts, records, "anomaly", "records").unionByName(surplus).unionByName(late)
