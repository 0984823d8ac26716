"""Calendar and fiscal attributes of a day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import date_key


def fiscal_year(day: Column, start_month: int) -> Column:
    """The fiscal year is named after the calendar year it ends in."""
    if start_month == 1:
        return F.year(day)
    return F.year(day) + (F.month(day) >= F.lit(start_month)).cast("int")


def fiscal_quarter(day: Column, start_month: int) -> Column:
    months_in = F.pmod(F.month(day) - F.lit(start_month), F.lit(12))
    return (F.floor(months_in / F.lit(3)) + F.lit(1)).cast("int")


def day_attributes(day: Column, fiscal_start_month: int = 7) -> dict[str, Column]:
    """Every column of the date dimension, in output order."""
    quarter = F.quarter(day)
    year_text = F.year(day).cast("string")
    quarter_label = F.concat(F.lit("Q"), quarter.cast("string"))
    f_year, f_quarter = fiscal_year(day, fiscal_start_month), fiscal_quarter(day, fiscal_start_month)
    f_label = F.concat(F.lit("FQ"), f_quarter.cast("string"))
    quarter_start = F.trunc(day, "quarter")
    year_start = F.trunc(day, "year")
    month_end = F.last_day(day)
    weekday = F.dayofweek(day)
    return {
        "date_sk": date_key(day),
        "full_date": day,
        "year_number": F.year(day),
        "quarter_number": quarter,
        "quarter_label": quarter_label,
        "quarter_name": F.concat(quarter_label, F.lit(" "), year_text),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short_name": F.date_format(day, "MMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_year": F.dayofyear(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "day_short_name": F.date_format(day, "EEE"),
        "is_weekend": weekday.isin(1, 7),
        "fiscal_year": f_year,
        "fiscal_quarter": f_quarter,
        "fiscal_quarter_label": f_label,
        "fiscal_year_quarter": F.concat(F.lit("FY"), f_year.cast("string"), F.lit("-"), f_label),
        "month_start_date": F.trunc(day, "month"),
        "month_end_date": month_end,
        "quarter_start_date": quarter_start,
        "quarter_end_date": F.last_day(F.add_months(quarter_start, 2)),
        "year_start_date": year_start,
        "year_end_date": F.date_add(F.add_months(year_start, 12), -1),
        "is_last_day_of_month": day == month_end,
        "is_last_day_of_year": (F.month(day) == 12) & (F.dayofmonth(day) == 31),
        "is_unknown": F.lit(False),
    }
