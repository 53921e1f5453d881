"""Where the four warehouse variants differ, as data."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# The unknown member of each variant.
MISSING_KEY = -1
MISSING_KEY_UNSIGNED = 4294967295


@dataclass(frozen=True)
class Profile:
    """One variant: its unknown members, how it reads cities, numbers and keys, its
    calendar, and what it makes of a missing velocity."""

    name: str
    unknown_key: int = MISSING_KEY
    unknown_label: str = "UNKNOWN"
    unknown_country: str = "UNKNOWN"
    unknown_class: str = "UNKNOWN"
    city_rule: str = "parts"  # "parts" or "position"
    numbers: str = "whole"  # "whole" or "truthy"
    blanks: str = "null"  # "null" or "empty"
    members: str = "trimmed"  # "trimmed" or "as is"; a blank text never finds a member
    velocity: str = "kept"  # "kept" without a value, "zero" or "required"
    time_keys: str = "ordinal"  # "ordinal", "identity" (from 1) or "unix" (of the very second)
    weekdays: str = "iso"  # "iso" or "sunday"
    full_date: str = "minute"  # "minute" or "day"
    missing_minutes: int = 0  # minutes the calendar lacks at its end
    # Full date, year, month, day, weekday, hour and minute of the unknown time, if it has one.
    unknown_time: tuple | None = (dt.datetime(1900, 1, 1), 1900, 1, 1, 1, 0, 0)


# Labels, keys and calendars per variant.
CANON = Profile("canon")
MSSQL = Profile(
    "mssql",
    unknown_country="UNK",
    unknown_class="-999",
    velocity="required",
    time_keys="identity",
    weekdays="sunday",
    missing_minutes=1439,
    unknown_time=None,
)
MARIADB = Profile("mariadb", unknown_country="UNK", unknown_class="-999", weekdays="sunday")
CLICKHOUSE = Profile(
    "clickhouse",
    unknown_key=MISSING_KEY_UNSIGNED,
    numbers="truthy",
    blanks="empty",
    members="as is",
    velocity="zero",
    time_keys="unix",
    unknown_time=None,
)
POSTGRES = Profile(
    "postgres",
    unknown_label="Unknown",
    unknown_country="Unknown",
    unknown_class="Unknown",
    city_rule="position",
    time_keys="identity",
    full_date="day",
    unknown_time=(dt.datetime(1900, 1, 1), -1, -1, -1, -1, -1, -1),
)
PROFILES = {p.name: p for p in (CANON, MSSQL, MARIADB, CLICKHOUSE, POSTGRES)}
