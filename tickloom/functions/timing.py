"""Time arithmetic on epoch microseconds, independent of calendar rules."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.params import MICROS


def micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def time_bucket(width_seconds: int, ts: Column) -> Column:
    """Start of the fixed-width bucket, counted from the epoch, that holds ``ts``."""
    us = micros(ts)
    return F.timestamp_micros(us - F.pmod(us, F.lit(width_seconds * MICROS)))


def utc_day(ts: Column) -> Column:
    """The calendar day in UTC, whatever the zone of the session."""
    us, day = micros(ts), 86_400 * MICROS
    return F.date_from_unix_date(((us - F.pmod(us, F.lit(day))) / day).cast("int"))


def ago(as_of: datetime | None, seconds: float) -> Column:
    """The moment ``seconds`` before ``as_of`` (default: now)."""
    end = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return F.timestamp_micros(F.unix_micros(end) - round(seconds * MICROS))


def event_order(ts: Column, trade_id: Column) -> Column:
    """Time, then trade id, as one number.

    A fixed-width decimal keeps ``min_by``/``max_by`` inside hash aggregation; a
    struct as ordering value would force every partition to be sorted first.
    """
    return micros(ts).cast("decimal(19,0)") * F.lit(Decimal(10**19)) + trade_id
