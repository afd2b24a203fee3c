"""Date and time column functions. The session time zone is UTC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def day_text(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd")


def epoch_parts(millis: Column) -> dict[str, Column]:
    """Epoch milliseconds to timestamp text and date text."""
    at = F.timestamp_millis(millis)
    return {"time_text": F.date_format(at, "yyyy-MM-dd HH:mm:ss"), "date_text": day_text(at)}


def calendar_parts(when: Column) -> dict[str, Column]:
    year = F.year(when)
    return {
        "year": year,
        "month": F.month(when),
        "hour": F.hour(when),
        "is_weekday": F.weekday(when) < 5,
        "decade": (F.floor(year / 10) * 10).cast("int"),
        "is_21st_century": year >= 2000,
        "iso_date": day_text(when),
    }


def seconds_to_hours(seconds: Column) -> Column:
    """Missing durations count as 0 hours."""
    return F.coalesce(seconds.cast("double") / 3600.0, F.lit(0.0))


def hours_between(start: Column, end: Column) -> Column:
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(3_600_000_000.0)


def date_offsets(day: Column, offsets: Sequence[int] = (-30, -7, -1, 1)) -> dict[str, Column]:
    """ISO text of the date shifted by each number of days."""
    out = {}
    for days in offsets:
        name = f"minus_{-days}_days" if days < 0 else f"plus_{days}_days"
        out[name] = day_text(F.date_add(day.cast("date"), days))
    return out


def month_third(day: Column) -> Column:
    """early up to the 10th, mid up to the 20th, late after it."""
    number = F.dayofmonth(day)
    return F.when(number <= 10, "early").when(number <= 20, "mid").otherwise("late")
