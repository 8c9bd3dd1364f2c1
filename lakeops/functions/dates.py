"""Event time parsing and day arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_ts(text: str | Column, pattern: str | None = None) -> Column:
    """Text to timestamp; malformed text gives null and a zone suffix is honoured.

    A literal 'Z' in a pattern would read UTC text as session-local time, so such a
    pattern is refused: use XXX or no pattern at all.
    """
    c = F.col(text) if isinstance(text, str) else text
    if pattern is None:
        return F.try_to_timestamp(c)
    if "'Z'" in pattern:
        raise ValueError("a quoted 'Z' ignores the zone; use XXX")
    return F.try_to_timestamp(c, F.lit(pattern))


def day_of(ts: str | Column) -> Column:
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def shift(ts: str | Column, days: Column | int = 0, hours: Column | int = 0, mins: Column | int = 0) -> Column:
    """A timestamp moved by an interval built from columns."""
    c = F.col(ts) if isinstance(ts, str) else ts
    parts = [p if isinstance(p, Column) else F.lit(p) for p in (days, hours, mins)]
    return c + F.make_dt_interval(*[p.cast("int") for p in parts])


def age_on(birth: str | Column, on: Column) -> Column:
    return F.year(on) - F.year(F.col(birth) if isinstance(birth, str) else birth)
