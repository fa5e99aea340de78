"""The acceptance rules of a usage record, stated once.

The flag and the reject reasons are derived from the same (reason, condition)
pairs, and these, like the anomaly counts, from the same table of required fields.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollbook.tariff import SERVICE_TECHNOLOGIES, SERVICES, TECHNOLOGIES

Rule = tuple[str, Column]


def common_rules(per_service_technology: bool = False) -> list[Rule]:
    if per_service_technology:
        technology_ok = reduce(
            or_,
            [
                (F.col("record_type") == service) & F.col("technology").isin(*technologies)
                for service, technologies in SERVICE_TECHNOLOGIES.items()
            ],
        )
    else:
        # Any listed technology passes for any service.
        technology_ok = F.col("technology").isin(*TECHNOLOGIES)
    return [
        ("service_unknown", F.col("record_type").isin(*SERVICES)),
        ("timestamp_missing", F.col("timestamp").isNotNull()),
        ("cell_missing", F.col("cell_id").isNotNull()),
        ("technology_missing", F.col("technology").isNotNull()),
        ("technology_unknown", technology_ok),
    ]


# The fields every record and each service must carry, and the
# reason given for a record whose field is absent or, for a quantity, not positive.
ALWAYS_REQUIRED = ("record_type", "timestamp", "cell_id", "technology")
SERVICE_REQUIRED = {
    "voice": {
        "caller_id": "caller_missing",
        "callee_id": "callee_missing",
        "duration_sec": "duration_not_positive",
    },
    "sms": {"sender_id": "sender_missing", "receiver_id": "receiver_missing"},
    "data": {
        "user_id": "user_missing",
        "data_volume_mb": "volume_not_positive",
        "session_duration_sec": "session_not_positive",
    },
}
QUANTITIES = ("duration_sec", "session_duration_sec", "data_volume_mb")


def service_rules() -> dict[str, list[Rule]]:
    def ok(column: str) -> Column:
        return F.col(column) > 0 if column in QUANTITIES else F.col(column).isNotNull()

    return {
        service: [(reason, ok(column)) for column, reason in required.items()]
        for service, required in SERVICE_REQUIRED.items()
    }


def is_valid(per_service_technology: bool = False, keep_unknown: bool = False) -> Column:
    """True for acceptable records.

    A NULL service makes the bare conjunction NULL, which would put the record
    in neither branch; it counts as rejected unless ``keep_unknown`` is set.
    """
    common = reduce(and_, [ok for _, ok in common_rules(per_service_technology)])
    by_service = reduce(
        or_,
        [
            reduce(and_, [ok for _, ok in rules], F.col("record_type") == service)
            for service, rules in service_rules().items()
        ],
    )
    flag = common & by_service
    return flag if keep_unknown else F.coalesce(flag, F.lit(False))


def reject_reasons(per_service_technology: bool = False) -> Column:
    """Names of the failed rules; empty exactly when the record is valid."""

    def failed(ok: Column) -> Column:
        return ~F.coalesce(ok, F.lit(False))

    checks = [
        F.when(failed(ok), F.lit(reason)) for reason, ok in common_rules(per_service_technology)
    ]
    for service, rules in service_rules().items():
        checks += [
            F.when((F.col("record_type") == service) & failed(ok), F.lit(reason))
            for reason, ok in rules
        ]
    return F.array_compact(F.array(*checks))
