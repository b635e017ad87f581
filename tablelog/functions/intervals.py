"""Interval strings of table properties, time strings of options, zone shifts."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Milliseconds of the units that an interval may use.
UNITS = {"week": 604_800_000, "day": 86_400_000, "hour": 3_600_000, "minute": 60_000, "second": 1000, "millisecond": 1, "microsecond": 0.001}
_PIECE = re.compile(r"([+-]?\d+)(\.\d+)?\s+([a-z]+?)s?(?=\s|$)\s*")


def interval_ms(text: str) -> int:
    """Milliseconds of `interval 1 week 2 days`; months and years are refused, fractions go with seconds only."""
    said = (text or "").strip().lower()
    rest = said.removeprefix("interval").strip() if said.startswith("interval") else said
    if not rest:
        raise ValueError(f"not an interval: {text!r}")
    total = 0.0
    while rest:
        m = _PIECE.match(rest)
        if not m:
            raise ValueError(f"not an interval: {text!r}")
        whole, part, unit = m.groups()
        if unit in ("month", "year"):
            raise ValueError(f"{unit}s have no fixed length: {text!r}")
        if unit not in UNITS or part and unit != "second":
            raise ValueError(f"not an interval: {text!r}")
        total += float(whole + (part or "")) * UNITS[unit]
        rest = rest[m.end() :]
    return int(total)


def timestamp_ms(text: str) -> int:
    """Milliseconds since 1970 of a date, or a date and time joined by T or a blank, with or without millis and Z; UTC."""
    m = re.fullmatch(r"(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2}):(\d{2}):(\d{2})(?:\.(\d{1,6}))?Z?)?", text.strip())
    if not m:
        raise ValueError(f"not a timestamp: {text!r}")
    y, mo, d, h, mi, s, frac = m.groups()
    at = datetime(int(y), int(mo), int(d), int(h or 0), int(mi or 0), int(s or 0), tzinfo=timezone.utc)
    return int(at.timestamp()) * 1000 + int((frac or "0").ljust(3, "0")[:3])


def shift_zone(column: Column, offset: str) -> Column:
    """A timestamp moved by an offset such as +02:00 or -5:30."""
    m = re.fullmatch(r"([+-]?)(\d{1,2}):(\d{2})(?::(\d{2}))?", offset.strip())
    if not m:
        raise ValueError(f"not an offset: {offset!r}")
    sign = -1 if m[1] == "-" else 1
    return column + F.make_dt_interval(F.lit(0), F.lit(sign * int(m[2])), F.lit(sign * int(m[3])), F.lit(sign * int(m[4] or 0)))
