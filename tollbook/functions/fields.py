"""Expressions over single record fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted event-time texts. A date alone is midnight; the
# zone letter is read as plain text, hence the UTC session zone.
EVENT_TIME_PATTERN = "yyyy-MM-dd['T'HH:mm:ss[.SSS]['Z']]"


def event_time(text: Column) -> Column:
    """Typed event time, NULL for any other shape (also under ANSI mode)."""
    return F.try_to_timestamp(text, F.lit(EVENT_TIME_PATTERN))


def subscriber() -> Column:
    """The paying party: caller, sender or data user, whichever is set."""
    return F.coalesce(F.col("caller_id"), F.col("sender_id"), F.col("user_id"))


def not_negative(column: Column, default: Column) -> Column:
    """NULL becomes the default and negative values become zero."""
    return F.greatest(F.coalesce(column, default), default)


def period_label(year: Column, month: Column) -> Column:
    return F.format_string("%d-%02d", year, month)


def digest(*parts: Column) -> Column:
    """128-bit key of several string columns.

    Each part goes in with its length, so ('ab', 'c') and ('a', 'bc') differ,
    and NULL differs from an empty text. 64 bits would be too few here: among
    1e10 events two are likely to collide.
    """
    framed = [
        F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts
    ]
    return F.md5(F.concat(*framed))


def event_key() -> Column:
    """Key of a rated event, from what makes the event unique."""
    return digest(
        F.col("record_type"),
        F.col("user_identifier"),
        F.unix_micros("event_time").cast("string"),
        F.col("cell_id"),
    )


def period_start(time: Column) -> Column:
    return F.trunc(time, "month")


def invoice_key(user: Column, start: Column) -> Column:
    """Key of an invoice, from its subscriber and first day."""
    return digest(user, start.cast("string"))
