"""Date column expressions (Monday weeks, tolerant parsers) and run-range resolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

ISO_DATE_RE = r"(\d{4}-\d{2}-\d{2})"
# ISO timestamp accepted by the export parser: date 'T' time [fraction] [zone].
ISO_TS_RE = r"^\d{4}-\d{2}-\d{2}T\d{2}(:\d{2}(:\d{2}(\.\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_to_date(c, fmt: str = "yyyy-MM-dd") -> Column:
    return F.call_function("try_to_date", _c(c), F.lit(fmt))


def week_start(c) -> Column:
    """Monday of the week of a date or timestamp (a DATE)."""
    return F.trunc(F.to_date(_c(c)), "week")


def day_of(c) -> Column:
    return F.to_date(_c(c))


def parse_yyyymmdd(c) -> Column:
    return try_to_date(c, "yyyyMMdd")


def parse_date_any(c) -> Column:
    """'2024-11-11', '2020-04-24 11:50:39 UTC', ISO with T/Z, or the first YYYY-MM-DD found
    anywhere; invalid calendar dates give NULL."""
    s = F.trim(_c(c).cast("string"))
    found = F.regexp_extract(s, ISO_DATE_RE, 1)
    return F.when(found != "", try_to_date(found))


def parse_export_date(c) -> Column:
    """Export-file date: exact YYYY-MM-DD, or an ISO timestamp with 'T' whose local date
    part is taken (no zone shift). Quotes, BOM and whitespace are stripped first."""
    s = F.regexp_replace(F.trim(_c(c)), '^["﻿]+|"+$', "")
    s = F.trim(s)
    return (F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), try_to_date(s))
            .when(s.rlike(ISO_TS_RE), try_to_date(F.substring(s, 1, 10))))


def resolve_range(start: str | None = None, end: str | None = None, lookback_days: int = 30,
                  today: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Explicit inclusive range when both ends are given, else today - lookback .. today."""
    if start and end:
        return dt.date.fromisoformat(start), dt.date.fromisoformat(end)
    today = today or dt.date.today()
    return today - dt.timedelta(days=max(lookback_days, 0)), today
