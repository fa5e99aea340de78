import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from tollbook.operators import rating
from tollbook.schemas import USAGE_COLUMNS

LAYOUT = (
    "record_type string, event_time timestamp, user_identifier string, cell_id string, "
    "technology string, duration_sec int, data_volume_mb double"
)
NOON = datetime(2024, 1, 10, 13)


def usage(spark, *rows):
    return spark.createDataFrame(rows, LAYOUT)


def event(kind="voice", time=NOON, tech="4G", seconds=None, mb=None, user="u", cell="c"):
    return (kind, time, user, cell, tech, seconds, mb)


def costs(spark, *rows):
    return [r.cost for r in rating.price(usage(spark, *rows)).collect()]


@pytest.mark.parametrize(
    ("time", "peak"),
    [
        ((7, 59, 59), False),
        ((8, 0, 0), True),
        ((11, 59, 59), True),
        ((12, 0, 0), False),
        ((16, 59, 59), False),
        ((17, 0, 0), True),
        ((19, 59, 59), True),
        ((20, 0, 0), False),
        ((0, 0, 0), False),
    ],
)
def test_peak_hours(spark, time, peak):
    at = datetime(2024, 1, 10, *time)
    expected = Decimal("1.5000") if peak else Decimal("1.0000")
    assert costs(spark, event(time=at, seconds=100)) == [expected]


def test_data_rates_and_discount_cliff(spark):
    assert costs(
        spark,
        event("data", tech="5G", mb=1000.0),
        event("data", tech="5G", mb=1000.01),
        event("data", tech="3G", mb=10.0),
        event("data", tech="4G", mb=10.0),
        event("data", tech="LTE", mb=10.0),
        event("data", tech="2G", mb=10.0),
        event("data", tech="2G", mb=0.0),
        event("data", tech="4G", mb=None),
    ) == [
        Decimal("120.0000"),
        Decimal("102.0010"),
        Decimal("0.8000"),
        Decimal("1.0000"),
        Decimal("0.9000"),
        None,
        Decimal("0.0000"),
        Decimal("0.0000"),
    ]


def test_flat_default_and_missing_quantities(spark):
    assert costs(
        spark,
        event("sms"),
        event("fax", seconds=60),
        event(None, seconds=60),
        event("voice", seconds=None),
        event("voice", seconds=-5),
    ) == [Decimal("0.0500")] + [Decimal("0.0000")] * 4


def test_amounts_beyond_the_column_are_dropped_and_counted(spark):
    priced = rating.price(
        usage(
            spark,
            event(seconds=2_000_000_000),
            event("data", mb=1e12),
            event("data", mb=float("nan")),
            event(seconds=60),
        )
    )
    assert [r.cost for r in priced.collect()] == [None, None, None, Decimal("0.6000")]
    assert rating.sanitize(priced).count() == 1
    report = rating.load_report(priced).first()
    assert (report.read_rows, report.loaded_rows, report.without_price) == (4, 1, 3)


def test_status_of_zero_and_missing_cost(spark):
    priced = rating.price(
        usage(spark, event(seconds=0), event("data", tech="2G", mb=1.0), event(seconds=1))
    )
    assert [r.rating_status for r in priced.collect()] == ["unrated", "unrated", "rated"]
    assert rating.rated_only(priced).count() == 1


def test_sanitize_fills_clamps_and_filters(spark):
    priced = rating.price(
        usage(
            spark,
            event(seconds=-5, mb=-1.0),
            event("sms"),
            event("sms", cell=None),
            event("sms", user=None),
            event("data", tech="2G", mb=1.0),
        )
    )
    rows = rating.sanitize(priced).collect()
    assert [(r.duration_sec, r.data_volume_mb) for r in rows] == [(0, Decimal("0.00"))] * 2
    report = rating.load_report(priced).first()
    assert (report.without_cell, report.without_subscriber, report.without_price) == (1, 1, 1)


def all_kinds(spark):
    rows = [
        event(kind, datetime(2024, 1, 10, hour), tech, seconds, mb)
        for kind in ("voice", "sms", "data", "fax", None)
        for hour in (3, 9, 18)
        for tech in ("2G", "3G", "4G", "5G", "LTE", None)
        for seconds in (None, -1, 0, 61)
        for mb in (None, -1.0, 999.99, 1000.0, 1000.01)
    ]
    return usage(spark, *rows)


@pytest.mark.parametrize("max_rows", [100_000, 0])
def test_rate_card_gives_the_same_prices(spark, max_rows):
    card = rating.rate_card(spark)
    by_card = rating.price_by_card(all_kinds(spark), card, max_broadcast_rows=max_rows)
    direct = rating.price(all_kinds(spark))
    assert by_card.exceptAll(direct).isEmpty() and direct.exceptAll(by_card).isEmpty()


def test_a_changed_card_changes_prices(spark):
    card = rating.rate_card(spark).withColumn("price", F.col("price") * 2)
    card = card.withColumn("price", F.col("price").cast("decimal(12,8)"))
    priced = rating.price_by_card(usage(spark, event("sms")), card)
    assert priced.first().cost == Decimal("0.1000")


def expected_cost(kind, time, tech, seconds, mb):
    """The tariff, restated with Python decimals."""
    if kind == "sms":
        amount = Decimal("0.05")
    elif kind == "voice" and seconds and seconds > 0:
        peak = time.hour in (8, 9, 10, 11, 17, 18, 19)
        amount = seconds * Decimal("0.015" if peak else "0.01")
    elif kind == "data" and mb and mb > 0:
        rates = {"3G": "0.08", "4G": "0.10", "5G": "0.12", "LTE": "0.09"}
        if tech not in rates:
            return None
        amount = Decimal(repr(mb)) * Decimal(rates[tech])
        if mb > 1000:
            amount *= Decimal("0.85")
    else:
        amount = Decimal(0)
    return amount.quantize(Decimal("0.0001"), ROUND_HALF_UP)


def test_prices_match_brute_force(spark):
    rng = random.Random(5)
    rows = [
        event(
            rng.choice(["voice", "sms", "data", "data", "mms"]),
            datetime(2024, 1, rng.randint(1, 31), rng.randrange(24), rng.randrange(60)),
            rng.choice(["2G", "3G", "4G", "5G", "LTE"]),
            rng.choice([None, -3, 0, rng.randrange(10**6)]),
            rng.choice([None, 0.0, round(rng.uniform(0, 2000), rng.choice([2, 6])), 1000.0]),
        )
        for _ in range(2000)
    ]
    expected = [expected_cost(kind, time, tech, s, mb) for kind, time, _, _, tech, s, mb in rows]
    assert costs(spark, *rows) == expected


def test_an_ambiguous_card_is_refused(spark):
    card = rating.rate_card(spark)
    with pytest.raises(ValueError):
        rating.price_by_card(usage(spark, event("sms")), card.union(card))


def test_status_counts(spark):
    counts = rating.status_counts(rating.price(all_kinds(spark)))
    assert sum(r.events for r in counts.collect()) == all_kinds(spark).count()


def test_usage_layout(spark):
    assert tuple(usage(spark, event()).columns) == USAGE_COLUMNS


def test_what_rounds_to_nothing_is_still_rated(spark):
    """0.00004 is charged and shown as 0.0000; what has no price or no volume is not."""
    rows = rating.price(usage(
        spark, event("data", tech="3G", mb=0.0005), event("data", tech="2G", mb=0.0005),
        event("data", tech="3G", mb=0.0), event("data", tech="3G", mb=1e12),
    )).collect()
    assert [(r.cost, r.rating_status) for r in rows] == [
        (Decimal("0.0000"), "rated"), (None, "unrated"), (Decimal("0.0000"), "unrated"), (None, "unrated"),
    ]


def test_volumes_too_wide_for_their_column_are_counted(spark):
    rows = rating.price(usage(spark, event("data", mb=1e12), event("data", mb=5.0), event()))
    assert rating.load_report(rows).first().volume_too_wide == 1
