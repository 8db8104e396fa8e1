"""Time expressions on timestamps without zone, independent of the session time zone."""

from __future__ import annotations

# Fixed value: the accepted shape of a timestamp; only the year must have all its digits.
TIMESTAMP_SHAPE = "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}$"


def parse_timestamp(c: str) -> str:
    """``yyyy-M-d H:m:s``, padded or not -> timestamp without zone; null when it is not one."""
    return f"CASE WHEN {c} RLIKE '{TIMESTAMP_SHAPE}' THEN try_cast({c} AS timestamp_ntz) END"


def format_timestamp(c: str) -> str:
    """``yyyy-MM-dd HH:mm:ss`` text (``date_format`` would go through the session time zone)."""
    return f"substring(cast({c} AS string), 1, 19)"


def epoch_minute(ts: str) -> str:
    """Minutes since 1970-01-01 on the wall clock."""
    return f"(unix_date(cast({ts} AS date)) * 1440L + hour({ts}) * 60 + minute({ts}))"


def epoch_micros(ts: str) -> str:
    """Microseconds since 1970-01-01 on the wall clock."""
    return f"({epoch_minute(ts)} * 60000000L + cast(extract(SECOND FROM {ts}) * 1000000 AS bigint))"


def plus_minutes(start: str, minutes: str) -> str:
    """A fixed start plus a number of minutes."""
    return f"timestampadd(MINUTE, {minutes}, timestamp_ntz'{start}')"
