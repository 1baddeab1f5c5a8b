"""Epoch-millisecond helpers.  'Local' means the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE_MS = 60 * 1000
HOUR_MS = 60 * MINUTE_MS
DAY_MS = 24 * HOUR_MS


def now_ms() -> Column:
    """Current time, one value for the whole query."""
    return F.unix_millis(F.current_timestamp())


def ms_ago(
    now: Column | None = None, *, minutes: int = 0, hours: int = 0, days: int = 0
) -> Column:
    """Epoch milliseconds of a moment before ``now`` (the query time by default)."""
    base = now_ms() if now is None else now
    return base - F.lit(minutes * MINUTE_MS + hours * HOUR_MS + days * DAY_MS).cast("bigint")


def iso_local(ms: Column) -> Column:
    """ISO date-time without zone; the fraction keeps only its significant digits."""
    text = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return F.regexp_replace(text, r"\.?0+$", "")


def iso_to_ms(text: Column) -> Column:
    """Epoch milliseconds of an ISO date-time, local or with a zone; null if unreadable."""
    return F.unix_millis(F.try_to_timestamp(text))


def seconds_to_ms(seconds: Column) -> Column:
    return F.coalesce(seconds, F.lit(0)).cast("bigint") * 1000
