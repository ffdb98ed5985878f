"""Time-zone aware column expressions.

Stored instants are UTC; calendars and displays use a local zone (London by
default).  All helpers are built-in expressions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_TZ = "Europe/London"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_local(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """UTC instant -> wall-clock time in ``tz`` (requires session zone UTC)."""
    return F.from_utc_timestamp(_c(ts), tz)


def local_to_utc(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Wall-clock time in ``tz`` -> UTC instant.

    On the autumn clock change the repeated hour resolves to the earlier
    instant; the missing spring hour maps forward.
    """
    return F.to_utc_timestamp(_c(ts), tz)


def local_date(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(to_local(ts, tz))


def date_key(d: Column | str) -> Column:
    """Integer ``yyyyMMdd`` key of a date column."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def local_date_key(ts: Column | str, tz: str = LOCAL_TZ) -> Column:
    return date_key(local_date(ts, tz))


def iso_day_of_week(d: Column | str) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.pmod(F.dayofweek(_c(d)) + F.lit(5), F.lit(7)) + F.lit(1)).cast("int")


def try_timestamp(text: Column | str, fmt: str | None = None) -> Column:
    """Parse text to a timestamp, null on bad input (ANSI-safe).

    ``to_timestamp`` raises under ANSI mode and would fail the whole batch
    before the row-level quality rules could reject the row.
    """
    if fmt is None:
        return F.try_to_timestamp(_c(text))
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def try_date(text: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.to_date(F.try_to_timestamp(_c(text), F.lit(fmt)))
