"""Time arithmetic on TIMESTAMP_NTZ columns, independent of the session time zone."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ts_micros(col: str | Column) -> Column:
    """Microseconds since the epoch of a TIMESTAMP_NTZ (no time-zone conversion)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), c)


def hours_between(later_us: Column, earlier_us: Column) -> Column:
    """Difference of two microsecond instants in hours, as a double."""
    return (later_us - earlier_us).cast("double") / F.lit(float(HOUR_US))


def trunc_hour(col: str | Column) -> Column:
    """Truncate a TIMESTAMP_NTZ to the hour, staying TIMESTAMP_NTZ."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("HOUR", F.timestamp_diff("HOUR", F.expr(_EPOCH), c), F.expr(_EPOCH))


_SPAN = re.compile(r"^(\d+)\s*(us|ms|s|min|h|d)$")
_UNIT_US = {"us": 1, "ms": 1_000, "s": 1_000_000, "min": 60_000_000, "h": HOUR_US, "d": DAY_US}


def parse_span_us(span: str | int) -> int:
    """'6h' -> microseconds.  Integers are taken as microseconds."""
    if isinstance(span, int):
        return span
    m = _SPAN.match(span.strip())
    if not m:
        raise ValueError(f"bad time span: {span!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2)]


def half_open_us(span: str | int) -> int:
    """Lower RANGE bound of the half-open time window (t - span, t] on microsecond order keys.

    A rolling time window of length h contains the rows with t - h < ts <= t, so the frame is
    ``rangeBetween(-(h_us - 1), 0)``: an hourly series has exactly 6 rows in '6h' and 1 row in '1h'.
    """
    return -(parse_span_us(span) - 1)
