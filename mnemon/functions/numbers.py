"""Rounding, clamping, day windows and vectors as column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_up(x: Column) -> Column:
    """To the nearest whole number, halves towards plus infinity."""
    return F.floor(x + 0.5)


def day_window(date: Column, zone: str) -> tuple[Column, Column]:
    """(first instant, last millisecond) of a local day, as UTC timestamps; the session's zone must be UTC."""
    day = F.to_date(date)
    start = F.to_utc_timestamp(day.cast("timestamp"), zone)
    end = F.to_utc_timestamp(F.date_add(day, 1).cast("timestamp"), zone) - F.expr("interval 1 millisecond")
    return start, end


def target_day(which: str, today: dt.date) -> dt.date:
    """``yesterday``, ``today`` or a date; anything else is an error."""
    if which == "today":
        return today
    if which == "yesterday":
        return today - dt.timedelta(days=1)
    return dt.datetime.strptime(which, "%Y-%m-%d").date()


def _dot(a: Column, b: Column) -> Column:
    zero = F.lit(0.0).cast("double")
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), zero, lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """In double precision; 0 for nulls, empty vectors, different lengths or a zero norm."""
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    alike = (F.size(a) == F.size(b)) & (F.size(a) > 0) & (norm > 0)
    return F.coalesce(F.when(alike, _dot(a, b) / norm), F.lit(0.0))
