"""Time columns: separations in days, decimal years, period labels.

Timestamps are read in UTC; the session zone is expected to be UTC (``firnflow.session.utc``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def micros(t: Column) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(t.cast("timestamp"))


def from_micros(us: Column) -> Column:
    """Zone-free timestamp of microseconds since the epoch."""
    return F.timestamp_micros(us.cast("long")).cast("timestamp_ntz")


def whole_days(days: Column) -> Column:
    """Full days in a separation, as INT."""
    return F.floor(days).cast("int")


def days_from_nanoseconds(ns: Column) -> Column:
    return ns / F.lit(86_400_000_000_000)


def rounded_days(days: Column) -> Column:
    """Nearest whole day, halves to the even one."""
    return F.bround(days).cast("int")


def decimal_year(t: Column) -> Column:
    """Year plus the share of its days gone by; the time of day does not count."""
    year = F.year(t)
    first, following = F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year + 1, F.lit(1), F.lit(1))
    return year + F.datediff(t.cast("date"), first) / F.datediff(following, first)


def day_label(t: Column) -> Column:
    return t.cast("date")


def week_label(t: Column) -> Column:
    """Sunday that closes the week."""
    return F.next_day(F.date_sub(t.cast("date"), 1), "SUN")


def month_label(t: Column) -> Column:
    """Last day of the month."""
    return F.last_day(t.cast("date"))


def periods_between(earlier: Column, later: Column, freq: str) -> Column:
    """How many periods lie from one period label to another."""
    if freq == "m":
        return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    days = F.datediff(later, earlier)
    return F.floor(days / 7).cast("int") if freq == "w" else days


def shift_period(label: Column, n: Column, freq: str) -> Column:
    """Label ``n`` periods on."""
    if freq == "m":
        return F.last_day(F.add_months(F.trunc(label, "month"), n))
    return F.date_add(label, n * 7 if freq == "w" else n)


PERIOD_LABELS = {"d": day_label, "w": week_label, "m": month_label}
