"""Calendar and clock expressions.

Keys are built with integer arithmetic rather than by formatting text: it is cheaper, keeps
filters on them range-comparable and does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dimsmith.functions._columns import ColumnLike, as_column


def date_key(when: ColumnLike) -> Column:
    """2005-05-24 becomes 20050524."""
    c = as_column(when)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def month_key(when: ColumnLike) -> Column:
    """First day of the month as a date key: 2005-05-24 becomes 20050501."""
    c = as_column(when)
    return (F.year(c) * 10000 + F.month(c) * 100 + 1).cast("int")


def iso_week_key(when: ColumnLike, calendar_year: bool = False) -> Column:
    """ISO year and week as one integer.

    ``calendar_year=True`` pairs the calendar year with the ISO week, the mixed form older
    loads used (2000-01-01 becomes 200052); it is not unique around New Year.
    """
    c = as_column(when)
    year = F.year(c) if calendar_year else F.extract(F.lit("YEAROFWEEK"), c)
    return (year * 100 + F.weekofyear(c)).cast("int")


def iso_week_label(when: ColumnLike) -> Column:
    c = as_column(when)
    year = F.extract(F.lit("YEAROFWEEK"), c).cast("string")
    return F.concat(year, F.lit("/"), _two_digits(F.weekofyear(c)))


def year_month(when: ColumnLike) -> Column:
    c = as_column(when)
    return F.concat(F.year(c).cast("string"), F.lit("/"), _two_digits(F.month(c)))


def quarter_label(when: ColumnLike) -> Column:
    return F.concat(F.lit("Q"), F.quarter(as_column(when)).cast("string"))


def year_quarter(when: ColumnLike) -> Column:
    c = as_column(when)
    return F.concat(F.year(c).cast("string"), F.lit("/"), quarter_label(c))


def week_start(when: ColumnLike) -> Column:
    day = F.to_date(as_column(when))
    return F.date_sub(day, F.weekday(day))


def week_end(when: ColumnLike) -> Column:
    day = F.to_date(as_column(when))
    return F.date_add(day, F.lit(6) - F.weekday(day))


def month_start(when: ColumnLike) -> Column:
    return F.trunc(F.to_date(as_column(when)), "MM")


def month_end(when: ColumnLike) -> Column:
    return F.last_day(F.to_date(as_column(when)))


def minute_of_day(when: ColumnLike) -> Column:
    c = as_column(when)
    return (F.hour(c) * 60 + F.minute(c)).cast("int")


def minute_label(when: ColumnLike) -> Column:
    """Clock time to the minute, ``HH:MM``."""
    c = as_column(when)
    return F.concat(_two_digits(F.hour(c)), F.lit(":"), _two_digits(F.minute(c)))


def clock(minute: ColumnLike) -> Column:
    """Minute of the day (0-1439) as ``HH:MM``."""
    c = as_column(minute)
    return F.concat(_two_digits(F.floor(c / 60)), F.lit(":"), _two_digits(c % 60))


def quarter_hour_band(minute: ColumnLike) -> Column:
    """The quarter of an hour a minute falls in, e.g. ``08:15 – 08:29``."""
    c = as_column(minute)
    first = c - c % 15
    return F.concat(clock(first), F.lit(" – "), clock(first + 14))


# First minute of each named part of the day; night wraps around midnight.
DAY_PARTS = (("Morning", 6 * 60), ("AM", 8 * 60 + 30), ("PM", 12 * 60), ("Evening", 18 * 60), ("Night", 22 * 60 + 30))
# Daylight runs from 07:00 to 19:59.
DAYLIGHT = (7 * 60, 20 * 60)


def day_part(minute: ColumnLike) -> Column:
    c = as_column(minute)
    label = F.lit("Night")
    for name, first in DAY_PARTS:
        label = F.when(c >= first, name).otherwise(label)
    return label


def day_night(minute: ColumnLike) -> Column:
    c = as_column(minute)
    return F.when((c >= DAYLIGHT[0]) & (c < DAYLIGHT[1]), "Day").otherwise("Night")


def overdue_days(taken: ColumnLike, returned: ColumnLike, allowed: ColumnLike) -> Column:
    """Whole days beyond the allowed period; zero while in time or not yet returned."""
    held = F.datediff(F.to_date(as_column(returned)), F.to_date(as_column(taken)))
    return F.coalesce(F.greatest(held - as_column(allowed), F.lit(0)), F.lit(0))


def eastern_date(when: ColumnLike) -> Column:
    """Calendar date in the fixed UTC-5 zone of a timestamp that carries UTC wall time."""
    return F.to_date(as_column(when) - F.expr("INTERVAL 5 HOURS"))


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")
