"""Time helpers. All assume the session time zone is UTC (see ``session.RUNTIME_CONF``)."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch, for TIMESTAMP and TIMESTAMP_NTZ alike."""
    return F.unix_micros(col(ts).cast("timestamp"))


def rfc3339(ts: Column | str) -> Column:
    """RFC 3339 text with second precision."""
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


# Unit suffixes of duration texts, in nanoseconds.
DURATION_UNITS = {
    "ns": 1,
    "us": 1_000,
    "µs": 1_000,
    "ms": 1_000_000,
    "s": 1_000_000_000,
    "m": 60_000_000_000,
    "h": 3_600_000_000_000,
}


def duration_us(value: float | str, unit: str = "s") -> int:
    """Microseconds of a duration: a number of ``unit``, or text such as ``100ms``, ``1.5s``, ``1h30m``."""
    if not isinstance(value, str):
        return int(value * DURATION_UNITS[unit] // 1000)
    sign, text = (-1, value[1:]) if value.startswith("-") else (1, value.removeprefix("+"))
    parts = re.findall(r"([0-9]+\.?[0-9]*|\.[0-9]+)(ns|us|µs|ms|s|m|h)", text)
    if text != "0" and (not parts or "".join(n + u for n, u in parts) != text):
        raise ValueError(f"not a duration: {value!r}")
    return sign * int(sum(float(n) * DURATION_UNITS[u] for n, u in parts) // 1000)
