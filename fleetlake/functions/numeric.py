"""Rounding, rates and micro-second arithmetic as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def settle(value: Column, digits: int = 8) -> Column:
    """Round half up after removing summation noise, so that ties fall the same way everywhere.

    An average of two-decimal readings is often an exact tie that floating point misses by one
    unit in the last place; rounding to 8 digits first restores the tie.
    """
    settled = F.round(value, 8)
    return settled if digits >= 8 else F.round(settled, digits)


def finite(value: Column) -> Column:
    """The value, or null if it is NaN or infinite."""
    return F.when(F.abs(value) <= F.lit(1.7976931348623157e308), value)


def rate(part: Column, whole: Column) -> Column:
    """part / whole as a double; null for an empty whole (plain division raises in ANSI mode)."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double"))


def percent_change(value: Column, reference: Column) -> Column:
    """(value - reference) / reference in percent; null where the reference is zero or missing."""
    return F.try_divide((value - reference) * F.lit(100.0), reference)


def percent_text(value: Column, digits: int = 2) -> Column:
    """A fraction as text, e.g. 0.0512 -> '5.12%'."""
    return F.concat(F.format_number(settle(value * 100, digits), digits), F.lit("%"))


def micros(ts: Column) -> Column:
    """Wall-clock microseconds since 1970, whatever the session zone.

    A zone-less time becomes an instant through the session zone; shifting it back makes the
    number independent of that zone (the shift is nothing in the UTC session).
    """
    return F.unix_micros(F.from_utc_timestamp(ts.cast("timestamp"), F.current_timezone()))


def instant(us: Column) -> Column:
    """The zone-less time of `micros`."""
    return F.to_utc_timestamp(F.timestamp_micros(us), F.current_timezone()).cast("timestamp_ntz")


def slot_start(us: Column, width_us: int) -> Column:
    """Start of the fixed-width slot around an instant, in exact integer arithmetic."""
    return us - F.pmod(us, F.lit(width_us))


# Interval units in microseconds.
_UNIT_US = {
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def interval_us(text: str) -> int:
    """'15 minutes' -> 900000000."""
    amount, unit = text.split()
    return int(amount) * _UNIT_US[unit.lower().rstrip("s")]
