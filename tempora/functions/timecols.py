"""Time columns, steps and grid positions.

Times are ``timestamp_ntz`` holding UTC wall-clock (the test tables load that
way) or ``long`` step indices.  Every ordered operator works on an integer
grid position ``pos = (t - origin) / step`` so that row shift equals clock
shift on an aligned grid and blocks of the grid can be computed without any
global ordering.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {
    "second": 1, "seconds": 1, "s": 1,
    "minute": 60, "minutes": 60, "min": 60, "m": 60,
    "hour": 3600, "hours": 3600, "h": 3600,
    "day": 86400, "days": 86400, "d": 86400,
    "week": 604800, "weeks": 604800, "w": 604800,
}


def step_seconds(step) -> int:
    """'1 hour', '1h', '7 days', 3600, timedelta → seconds."""
    if isinstance(step, dt.timedelta):
        return int(step.total_seconds())
    if isinstance(step, (int, float)):
        return int(step)
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", str(step))
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"cannot parse step {step!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def micros(c) -> Column:
    """Microseconds since epoch of a timestamp / timestamp_ntz column."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(c.cast("timestamp"))


def from_micros(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(c).cast("timestamp_ntz")


def to_micros_value(t) -> int:
    """Python datetime (naive = UTC) or ISO string → epoch microseconds."""
    if isinstance(t, str):
        t = dt.datetime.fromisoformat(t)
    if isinstance(t, dt.date) and not isinstance(t, dt.datetime):
        t = dt.datetime(t.year, t.month, t.day)
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(round(t.timestamp() * 1_000_000))


def from_micros_value(us: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(us))


def position(time_col: str, origin, step, integer_time: bool = False) -> Column:
    """Grid position of ``time_col`` relative to ``origin`` in units of ``step``."""
    if integer_time:
        return ((F.col(time_col) - F.lit(int(origin))) / F.lit(int(step))).cast("long")
    step_us = step_seconds(step) * 1_000_000
    return F.floor((micros(time_col) - F.lit(to_micros_value(origin))) / F.lit(step_us)).cast("long")


def time_at(pos: Column, origin, step, integer_time: bool = False) -> Column:
    """Inverse of :func:`position`."""
    if integer_time:
        return (F.lit(int(origin)) + pos * F.lit(int(step))).cast("long")
    step_us = step_seconds(step) * 1_000_000
    return from_micros(F.lit(to_micros_value(origin)) + pos * F.lit(step_us))


def shift_time(c, n_steps: int, step) -> Column:
    """``c + n_steps * step`` for timestamp_ntz columns (exact, no DST)."""
    c = F.col(c) if isinstance(c, str) else c
    return from_micros(micros(c) + F.lit(int(n_steps) * step_seconds(step) * 1_000_000))


def truncate(c, step) -> Column:
    """Floor a timestamp to a multiple of ``step`` since the epoch (UTC)."""
    c = F.col(c) if isinstance(c, str) else c
    s = step_seconds(step)
    if s == 3600:
        return F.date_trunc("hour", c.cast("timestamp")).cast("timestamp_ntz")
    if s == 86400:
        return F.date_trunc("day", c.cast("timestamp")).cast("timestamp_ntz")
    us = s * 1_000_000
    return from_micros(F.floor(micros(c) / F.lit(us)) * F.lit(us))
