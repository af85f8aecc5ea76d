"""Date, week and time-of-day dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimsmith import functions as fn
from dimsmith.functions.dates import clock
from dimsmith.sources import series

# Holidays that fall on the same month and day every year, as MMDD numbers.
HOLIDAYS: dict[str, tuple[int, ...]] = {
    "americanholiday": (101, 704, 1225, 1226),
    "austrianholiday": (101, 106, 501, 815, 1101, 1208, 1225, 1226),
    "canadianholiday": (101, 701, 1225, 1226),
}
# Named periods of the year, first and last MMDD.
PERIODS = (("Summer break", 701, 831), ("Christmas season", 1115, 1225))
# The winter break starts after the first and ends with the second MMDD.
WINTER_BREAK = (1225, 106)
# Start of the default calendar and its number of days.
DEFAULT_START, DEFAULT_DAYS = "2000-01-01", 7653

MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def _named(names: Sequence[str], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)


def month_name(day: Column) -> Column:
    return _named(MONTH_NAMES, F.month(day))


def weekday_name(day: Column) -> Column:
    return _named(DAY_NAMES, F.weekday(day) + 1)


def period_name(month_day: Column) -> Column:
    label = F.when((month_day > WINTER_BREAK[0]) | (month_day <= WINTER_BREAK[1]), "Winter break").otherwise("Normal")
    for name, first, last in PERIODS:
        label = F.when(month_day.between(first, last), name).otherwise(label)
    return label


def date_attributes(days: DataFrame, day: str = "day", holidays: Mapping[str, Sequence[int]] = HOLIDAYS) -> DataFrame:
    """The date dimension's attributes for the days given; a pure projection."""
    d = F.col(day)
    month_day = F.month(d) * 100 + F.dayofmonth(d)
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    formatted = F.concat(two(F.dayofmonth(d)), F.lit(". "), two(F.month(d)), F.lit(". "), F.year(d).cast("string"))
    return days.select(
        fn.date_key(d).alias("date_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        month_name(d).alias("monthname"),
        F.dayofmonth(d).alias("day"),
        F.dayofyear(d).alias("dayofyear"),
        weekday_name(d).alias("weekdayname"),
        F.weekofyear(d).alias("calendarweek"),
        formatted.alias("formatteddate"),
        fn.quarter_label(d).alias("quartal"),
        fn.year_quarter(d).alias("yearquartal"),
        fn.year_month(d).alias("yearmonth"),
        fn.iso_week_label(d).alias("yearcalendarweek"),
        F.when(F.weekday(d) >= 5, "Weekend").otherwise("Weekday").alias("weekend"),
        *[
            F.when(month_day.isin(list(listed)), "Holiday").otherwise("No holiday").alias(name)
            for name, listed in holidays.items()
        ],
        period_name(month_day).alias("period"),
        fn.week_start(d).alias("cwstart"),
        fn.week_end(d).alias("cwend"),
        fn.month_start(d).alias("monthstart"),
        fn.month_end(d).alias("monthend"),
    )


def date_dimension(spark: SparkSession, start: str = DEFAULT_START, count: int = DEFAULT_DAYS, **kwargs) -> DataFrame:
    return date_attributes(series.days(spark, start, count), **kwargs)


def week_attributes(days: DataFrame, day: str = "day") -> DataFrame:
    """One row per ISO week; month and quarter are those of the week's Thursday, which decides its ISO year."""
    starts = days.select(fn.week_start(day).alias("cwstart")).distinct()
    start = F.col("cwstart")
    thursday = F.date_add(start, 3)
    return starts.select(
        fn.iso_week_key(start).alias("week_id"),
        F.year(thursday).alias("year"),
        F.month(thursday).alias("month"),
        month_name(thursday).alias("monthname"),
        F.weekofyear(start).alias("calendarweek"),
        fn.quarter_label(thursday).alias("quartal"),
        fn.year_quarter(thursday).alias("yearquartal"),
        fn.year_month(thursday).alias("yearmonth"),
        fn.iso_week_label(start).alias("yearcalendarweek"),
        start,
        F.date_add(start, 6).alias("cwend"),
        fn.month_start(thursday).alias("monthstart"),
        fn.month_end(thursday).alias("monthend"),
    )


def week_month_attributes(days: DataFrame, day: str = "day") -> DataFrame:
    """The older form of the week dimension: one row per week *and* month, keyed by calendar year
    and ISO week. Its key is not unique for weeks that span two months."""
    d = F.col(day)
    return days.select(
        fn.iso_week_key(d, calendar_year=True).alias("week_id"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        month_name(d).alias("monthname"),
        F.weekofyear(d).alias("calendarweek"),
        fn.quarter_label(d).alias("quartal"),
        fn.year_quarter(d).alias("yearquartal"),
        fn.year_month(d).alias("yearmonth"),
        fn.iso_week_label(d).alias("yearcalendarweek"),
        fn.week_start(d).alias("cwstart"),
        fn.week_end(d).alias("cwend"),
        fn.month_start(d).alias("monthstart"),
        fn.month_end(d).alias("monthend"),
    ).distinct()


def week_dimension(spark: SparkSession, start: str = DEFAULT_START, count: int = DEFAULT_DAYS) -> DataFrame:
    return week_attributes(series.days(spark, start, count))


def time_dimension(spark: SparkSession) -> DataFrame:
    """One row per minute of the day."""
    m = F.col("minute")
    return series.minutes_of_day(spark).select(
        clock(m).alias("timeofday"),
        F.floor(m / 60).cast("int").alias("hour"),
        fn.quarter_hour_band(m).alias("quarterhour"),
        m,
        fn.day_part(m).alias("daytimename"),
        fn.day_night(m).alias("daynight"),
    )
