"""Prices, allowances and valid values. Every operator takes them as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# Services and the network technologies listed for each.
SERVICES = ("voice", "sms", "data")
SERVICE_TECHNOLOGIES = {
    "voice": ("2G", "3G", "4G", "5G"),
    "sms": ("2G", "3G", "4G"),
    "data": ("3G", "4G", "5G", "LTE"),
}
TECHNOLOGIES = tuple(sorted({t for ts in SERVICE_TECHNOLOGIES.values() for t in ts}))


@dataclass(frozen=True)
class Tariff:
    """Prices of single events."""

    # Price per second, per message and per megabyte.
    voice_rate: Decimal = Decimal("0.01")
    voice_peak_rate: Decimal = Decimal("0.015")
    peak_hours: tuple[tuple[int, int], ...] = ((8, 11), (17, 19))  # inclusive
    sms_price: Decimal = Decimal("0.05")
    data_rates: dict[str, Decimal] = field(
        default_factory=lambda: {
            "3G": Decimal("0.08"),
            "4G": Decimal("0.10"),
            "5G": Decimal("0.12"),
            "LTE": Decimal("0.09"),
        }
    )
    volume_threshold_mb: Decimal = Decimal("1000")
    volume_discount: Decimal = Decimal("0.15")


@dataclass(frozen=True)
class BillingTerms:
    """What happens to a month of rated usage before it becomes a bill."""

    # Allowance, prices and percentages of a monthly bill.
    free_minutes: int = 100
    overage_per_minute: float = 0.01
    loyalty_discount: float = 0.1
    fixed_promo: float = 20.0
    vat_rate: float = 0.2
    # The promotion is taken off every service line, so a small line goes
    # negative; True stops it at zero.
    floor_at_zero: bool = False


DEFAULT_TARIFF = Tariff()
DEFAULT_TERMS = BillingTerms()
