"""Time helpers (F4-F7): minute floor, epoch minute, ISO text both ways."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def minute_floor(ts: Column) -> Column:
    """Minute start as a zone-less UTC timestamp (session zone pinned to UTC)."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def epoch_minute(ts: Column) -> Column:
    """Whole minutes since 1970-01-01 UTC (session zone is pinned to UTC)."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(60_000_000)).cast("long")


def to_iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def parse_iso(text: Column) -> Column:
    """ISO-8601 text -> timestamp, null when malformed (never raises under ANSI)."""
    return F.try_to_timestamp(text)


def window_end(start: Column, minutes: int = 1) -> Column:
    return start + F.expr(f"INTERVAL {int(minutes)} MINUTES")
