"""Times as numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DAY_US = 86_400_000_000


def micros(col: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp's wall clock, whatever the session's zone."""
    t = col.cast("timestamp_ntz")
    days = F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    seconds = (F.extract(F.lit("SECOND"), t) * 1_000_000).cast("bigint")
    return days * DAY_US + F.hour(t).cast("bigint") * 3_600_000_000 + F.minute(t).cast("bigint") * 60_000_000 + seconds


def seconds_between(a: Column, b: Column) -> Column:
    """Whole-second boundaries crossed from ``a`` to ``b``: .9 s to 1.1 s is 1."""
    return F.floor(micros(b) / 1_000_000).cast("bigint") - F.floor(micros(a) / 1_000_000).cast("bigint")
