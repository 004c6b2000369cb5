"""Dates as ``yyyyMMdd`` integers."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed_date(text: Column) -> Column:
    """Date of a ``yyyyMMdd`` or ``yyyy-MM-dd`` string; null for any other form."""
    compact = F.when(
        text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd"))
    )
    dashed = F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))
    )
    return F.coalesce(compact, dashed).cast("date")


def date_string(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def int_to_date(value: Column) -> Column:
    return F.to_date(value.cast("string"), "yyyyMMdd")


def date_id(text: str | None, today: date | None = None, zone: str | None = None) -> int:
    """Driver-side form for job arguments; an absent date is today (UTC or ``zone``)."""
    if text:
        for form in ("%Y%m%d", "%Y-%m-%d"):
            try:
                return int(datetime.strptime(text, form).strftime("%Y%m%d"))
            except ValueError:
                continue
        raise ValueError(f"not a yyyyMMdd or yyyy-MM-dd date: {text!r}")
    if today is None:
        tz = timezone.utc
        if zone:
            from zoneinfo import ZoneInfo

            tz = ZoneInfo(zone)
        today = datetime.now(tz).date()
    return int(today.strftime("%Y%m%d"))
