"""Time expressions. All times are zone-less, so no result depends on the
session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The calendar's first minute, its end (exclusive) and first key.
CALENDAR_START = dt.date(2024, 1, 1)
CALENDAR_END = dt.date(2026, 1, 1)
FIRST_TIME_KEY = 1104071
UNKNOWN_KEY = -1

# Czech month names, January first.
CZECH_MONTHS = [
    "Leden", "Únor", "Březen", "Duben", "Květen", "Červen",
    "Červenec", "Srpen", "Září", "Říjen", "Listopad", "Prosinec",
]

MINUTES_PER_DAY = 24 * 60


def parse_utc(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f`` with one to six fraction digits, else NULL."""
    shaped = F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}$"), text)
    return shaped.try_cast("timestamp_ntz")


def day_ordinal(ts: Column, start: dt.date) -> Column:
    return F.date_diff(F.to_date(ts), F.lit(start))


def minute_ordinal(ts: Column, start: dt.date) -> Column:
    """Minutes from midnight of ``start`` to the minute of ``ts``."""
    return day_ordinal(ts, start) * MINUTES_PER_DAY + F.hour(ts) * 60 + F.minute(ts)


def time_key(
    ts: Column,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    first_key: int = FIRST_TIME_KEY,
    missing_minutes: int = 0,
) -> Column:
    """Key of the calendar minute of ``ts``, or the unknown key outside it.

    The calendar numbers its minutes in order, so the key needs no join.
    """
    ordinal = minute_ordinal(ts, start)
    inside = ordinal.between(0, (end - start).days * MINUTES_PER_DAY - 1 - missing_minutes)
    return F.when(inside, (ordinal + first_key).cast("int")).otherwise(F.lit(UNKNOWN_KEY))


def unix_seconds(ts: Column) -> Column:
    seconds = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return day_ordinal(ts, dt.date(1970, 1, 1)).cast("long") * 86400 + seconds


def truncated(ts: Column, grain: str) -> Column:
    return F.date_trunc(grain, ts).cast("timestamp_ntz")


def iso_weekday(ts: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(ts) + 1


def week_bucket(ts: Column) -> Column:
    """First day of the seven-day chunk a time falls into (chunks start on Mondays)."""
    return F.to_date(F.date_trunc("week", ts))


def czech_month(month: Column) -> Column:
    names = F.array(*[F.lit(name) for name in CZECH_MONTHS])
    return F.element_at(names, month.cast("int"))


def year_month_sort(year: Column, month: Column) -> Column:
    return year * 100 + month


def month_year_label(year: Column, month: Column) -> Column:
    """``2024-03 Březen``: sorts by text and reads well."""
    return F.concat(
        year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"), F.lit(" "), czech_month(month)
    )
