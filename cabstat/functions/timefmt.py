"""Event-time parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed formats of the feeds.
FEED_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
ISO_OFFSET_FORMAT = "yyyy-MM-dd'T'HH:mm:ssxxx"
RFC1123_FORMAT = "EEE, d MMM yyyy HH:mm:ss 'GMT'"


def parse_event_time(text: Column | str, fmt: str = FEED_TIME_FORMAT) -> Column:
    """String to TIMESTAMP with a pattern, null on failure (ANSI-safe)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.try_to_timestamp(c, F.lit(fmt))


def rfc1123(ts: Column | str) -> Column:
    """RFC 1123 date string of a UTC timestamp, e.g. ``Tue, 3 Jun 2008 11:05:30 GMT``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, RFC1123_FORMAT)
