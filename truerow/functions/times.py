"""Naive UTC times: parsing on columns, and 'since' arguments on the driver."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONED = r":[0-9].*(?:[zZ]|[+-][0-9]{2}(?::?[0-9]{2})?)\s*$"


def utc_timestamp(text: Column) -> Column:
    """TIMESTAMP_NTZ in UTC, NULL when the text is no date.

    A text with an offset becomes the UTC instant; one without is taken as UTC.
    The result does not depend on the session time zone.
    """
    dated = F.when(text.like("%____-_%-_%"), text)
    zoned = F.convert_timezone(
        F.current_timezone(),
        F.lit("UTC"),
        dated.try_cast("timestamp").cast("timestamp_ntz"),
    )
    return F.when(dated.rlike(_ZONED), zoned).otherwise(dated.try_cast("timestamp_ntz"))


# Relative durations are a positive count and h, d, m (months) or y.
_DURATION = re.compile(r"([1-9][0-9]*)([hdmy])")
_OFFSETS = {"h": "hours", "d": "days", "m": "months", "y": "years"}


def parse_since(value: str | None, now: datetime | None = None) -> datetime | None:
    """An absolute ISO time or a duration such as ``10h``, ``2d``, ``3m``, ``1y``.

    Month and year steps stay within the month. The result is naive UTC.
    """
    text = (value or "").strip()
    if not text:
        return None
    duration = _DURATION.fullmatch(text)
    if duration:
        start = now or datetime.now().astimezone()
        step = {_OFFSETS[duration[2]]: int(duration[1])}
        return naive_utc((pd.Timestamp(start) - pd.DateOffset(**step)).to_pydatetime())
    try:
        return naive_utc(datetime.fromisoformat(text))
    except ValueError:
        raise ValueError(
            f"{text!r} is neither a time such as 2026-05-08T14:30 "
            "nor a duration such as 10h, 2d, 3m or 1y."
        ) from None


def naive_utc(value: datetime) -> datetime:
    return value.astimezone(UTC).replace(tzinfo=None)


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def utc_text(value: datetime) -> str:
    """ISO text with milliseconds and a Z."""
    return value.isoformat(timespec="milliseconds") + "Z"


# The allowed spans of a fetch window.
MAX_WINDOW = {"days": 3650, "months": 120}


def window_start(now: datetime, days: int | None = None, months: int | None = None) -> datetime:
    """Start of the last ``days`` days or ``months`` calendar months."""
    if (days is None) == (months is None):
        raise ValueError("Give either days or months.")
    unit, amount = ("days", days) if months is None else ("months", months)
    if not 1 <= amount <= MAX_WINDOW[unit]:
        raise ValueError(f"{unit} must be between 1 and {MAX_WINDOW[unit]}.")
    if unit == "days":
        return now - timedelta(days=amount)
    return (pd.Timestamp(now) - pd.DateOffset(months=amount)).to_pydatetime()
