"""Column functions: dates, text and change predicates. Everything stays JVM-side."""

from dimsmith.functions.compare import any_changed
from dimsmith.functions.dates import (
    date_key,
    day_night,
    day_part,
    eastern_date,
    iso_week_key,
    iso_week_label,
    minute_label,
    minute_of_day,
    month_end,
    month_key,
    month_start,
    overdue_days,
    quarter_hour_band,
    quarter_label,
    week_end,
    week_start,
    year_month,
    year_quarter,
)
from dimsmith.functions.text import clean_key, full_name, money, name_case, search_tokens, text_array, unreadable_money

__all__ = [
    "any_changed",
    "clean_key",
    "date_key",
    "day_night",
    "day_part",
    "eastern_date",
    "full_name",
    "iso_week_key",
    "iso_week_label",
    "minute_label",
    "minute_of_day",
    "money",
    "month_end",
    "month_key",
    "month_start",
    "name_case",
    "overdue_days",
    "quarter_hour_band",
    "quarter_label",
    "search_tokens",
    "text_array",
    "unreadable_money",
    "week_end",
    "week_start",
    "year_month",
    "year_quarter",
]
