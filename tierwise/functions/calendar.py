"""Date and time functions with the source data's conventions, as SQL text."""

from __future__ import annotations

# Full English names, Sunday first.
DAY_NAMES = (
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
)


def day_of_week(x: str) -> str:
    """0 for Sunday up to 6 for Saturday."""
    return f"CAST(dayofweek({x}) - 1 AS SMALLINT)"


def day_name(x: str) -> str:
    """Full English weekday name; a lookup is cheaper than a date formatter."""
    names = ", ".join(f"'{d}'" for d in DAY_NAMES)
    return f"element_at(array({names}), dayofweek({x}))"


def _minute_number(x: str) -> str:
    # Calendar fields only: no zone conversion, whichever kind of timestamp.
    return f"(unix_date(CAST({x} AS DATE)) * 1440L + hour({x}) * 60 + minute({x}))"


def minutes_between(start: str, end: str) -> str:
    """Number of minute boundaries crossed, so 00:00:59 to 00:01:00 is one."""
    return f"({_minute_number(end)} - {_minute_number(start)})"
