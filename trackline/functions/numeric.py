"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, digits: int) -> Column:
    """Round half-up after passing through DECIMAL(38,12).

    Sums are order-dependent in the last bits; the decimal step absorbs that
    noise so values on an exact half (common for means of 3-decimal speeds)
    round the same way on every engine.
    """
    return F.round(c.try_cast("decimal(38,12)"), digits).cast("double")


def ntz_literal(value) -> Column:
    """A TIMESTAMP_NTZ literal from a Python datetime/date/str, independent of any time zone."""
    import datetime as dt
    if isinstance(value, dt.datetime):
        text = value.replace(tzinfo=None).isoformat(sep=" ")
    elif isinstance(value, dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")
