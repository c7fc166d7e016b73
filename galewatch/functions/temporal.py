"""Columns from ``created_at`` text, laid out as ``Mon Aug 28 10:11:12 +0000 2017``.

Everything is read from the text itself, so results do not depend on the
session time zone; malformed text gives null, also under ANSI mode.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK = r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$"


def date_text(created_at: Column) -> Column:
    """``Mon Aug 28``: weekday, month and day, no year."""
    return F.substring(created_at, 1, 10)


def time_text(created_at: Column) -> Column:
    """``10:11:12``."""
    return F.substring(created_at, 12, 8)


def hour(clock: Column) -> Column:
    """Hour of an ``HH:mm:ss`` text, null when it is not one."""
    return F.when(clock.rlike(CLOCK), F.substring(clock, 1, 2).cast("int"))


def calendar_text(created_at: Column) -> Column:
    """``Aug 28 2017``."""
    return F.concat(F.substring(created_at, 5, 7), F.substring(created_at, 27, 4))


def month_day(calendar: Column) -> Column:
    """``Aug 28 2017`` -> ``08-28``. The year decides whether Feb 29 exists."""
    return F.date_format(F.try_to_date(calendar, "MMM dd yyyy"), "MM-dd")


def instant(created_at: Column) -> Column:
    """The whole text as a timestamp. The weekday is left out: it cannot be parsed."""
    return F.try_to_timestamp(F.substring(created_at, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))
