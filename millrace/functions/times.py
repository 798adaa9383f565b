"""Time expressions that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_us(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less timestamp."""
    since = ts.cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(20,6)") * 1000000).cast("long")


def epoch_ms(ts: Column) -> Column:
    """Milliseconds since 1970, cut off as a Java clock does."""
    return F.floor(epoch_us(ts) / 1000)


def instant(ts: Column) -> Column:
    """A zone-less timestamp read as UTC."""
    return F.timestamp_micros(epoch_us(ts))


def session_duration(start: Column, end: Column) -> Column:
    """Milliseconds between the first and last event."""
    return epoch_ms(end) - epoch_ms(start)
