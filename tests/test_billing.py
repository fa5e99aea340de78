from datetime import date, datetime
from decimal import Decimal

import pytest

from tollbook.operators import billing, invoicing
from tollbook.schemas import RATED_TABLE, SUMMARY_COLUMNS
from tollbook.tariff import BillingTerms

RATED = RATED_TABLE


def rated(spark, *rows):
    full = [
        (f"id{i}", kind, time, user, "c", "4G", Decimal(cost), seconds, Decimal(mb), "rated")
        for i, (user, kind, time, cost, seconds, mb) in enumerate(rows)
    ]
    return spark.createDataFrame(full, RATED)


JAN, FEB = datetime(2024, 1, 31, 23, 59, 59), datetime(2024, 2, 1)


def bill(spark, *rows, terms=BillingTerms()):
    return billing.summary(billing.bill(rated(spark, *rows), terms)).first()


@pytest.mark.parametrize(
    ("seconds", "adjusted", "final"),
    [
        (6000, 0.0, "-24.00"),
        (6001, 0.01 / 60, "-24.00"),
        (12000, 1.0, "-22.92"),
        (600000, 99.0, "82.92"),
    ],
)
def test_voice_allowance(spark, seconds, adjusted, final):
    row = bill(spark, ("u", "voice", JAN, "50", seconds, "0"))
    assert row.adjusted_cost == pytest.approx(adjusted, abs=1e-12)
    assert row.final_cost == Decimal(final)
    assert row.total_cost == Decimal("50.0000")


def test_other_services_keep_their_cost(spark):
    row = bill(spark, ("u", "data", JAN, "100", 7000, "5"))
    assert (row.adjusted_cost, row.final_cost) == (100.0, Decimal("84.00"))


def test_floor_is_an_option(spark):
    row = bill(spark, ("u", "sms", JAN, "0.05", 0, "0"), terms=BillingTerms(floor_at_zero=True))
    assert (row.discounted_cost, row.final_cost) == (0.0, Decimal("0.00"))


@pytest.mark.parametrize(
    ("amount", "expected"), [(0.125, "0.13"), (-0.125, "-0.13"), (2.675, "2.68"), (None, None)]
)
def test_money_rounds_half_away_from_zero(spark, amount, expected):
    frame = spark.createDataFrame([(amount,)], "discounted_cost double")
    cost = billing.apply_tax(frame, BillingTerms(vat_rate=0.0)).first().final_cost
    assert cost == (Decimal(expected) if expected else None)


def test_a_value_just_below_a_half_cent_is_rounded_down(spark):
    """379.375 * 0.9 - 20 = 321.4375; times 1.2 the double is 385.72499999999997."""
    row = bill(spark, ("u", "data", JAN, "379.375", 0, "0"))
    assert row.final_cost == Decimal("385.72")


def test_a_bill_beyond_the_declared_column_is_still_a_figure(spark):
    events = [("u", "data", JAN, "999999.9999", 0, "0")] * 400
    assert bill(spark, *events).final_cost > Decimal("99999999.99")


def test_months_and_services_are_separate_lines(spark):
    rows = [
        ("u", "sms", JAN, "0.05", 0, "0"),
        ("u", "sms", FEB, "0.05", 0, "0"),
        ("u", "data", FEB, "1", 0, "0"),
        ("v", "sms", FEB, "0.05", 0, "0"),
        ("v", "sms", FEB, "0.05", 0, "0"),
    ]
    lines = billing.summary(billing.bill(rated(spark, *rows))).collect()
    assert sorted(
        (r.customer_id, r.billing_year, r.billing_month, r.service, r.event_count) for r in lines
    ) == [
        ("u", 2024, 1, "sms", 1),
        ("u", 2024, 2, "data", 1),
        ("u", 2024, 2, "sms", 1),
        ("v", 2024, 2, "sms", 2),
    ]


def test_pivot_has_nulls_for_unused_services_and_adds_up(spark):
    rows = [("u", "sms", JAN, "0.05", 0, "0"), ("u", "voice", JAN, "1.5", 100, "0")]
    row = billing.service_pivot(rated(spark, *rows), date(2024, 2, 1)).first()
    assert (row.sms_cost, row.voice_cost, row.data_cost) == (
        Decimal("0.0500"),
        Decimal("1.5000"),
        None,
    )
    assert row.total_cost == Decimal("1.5500") and row.invoice_date == date(2024, 2, 1)


def test_documents(spark):
    summary = billing.summary(billing.bill(rated(spark, ("u", "data", FEB, "100", 0, "0"))))
    row = billing.documents(summary).first()
    assert (row.billing_period, row.total_events, row.final_cost_MAD) == ("2024-02", 1, 84.0)
    assert tuple(summary.columns) == SUMMARY_COLUMNS


def test_invoices_and_line_items(spark):
    events = rated(
        spark,
        ("u", "sms", JAN, "0.05", 0, "0"),
        ("u", "voice", JAN, "1.5", 100, "0"),
        ("u", "sms", FEB, "0.05", 0, "0"),
    )
    headers = invoicing.invoice_headers(events)
    january = headers.filter("billing_period_start = date'2024-01-01'").first()
    assert january.billing_period_end == date(2024, 1, 31)
    assert january.total_cost == Decimal("1.5500") and january.paid is False
    items = invoicing.line_items(events)
    assert items.filter(items.invoice_id == january.invoice_id).count() == 2
    joined = invoicing.line_items_of(headers, events)
    assert items.exceptAll(joined).isEmpty() and joined.exceptAll(items).isEmpty()
