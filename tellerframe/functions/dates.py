"""Ages, spans and calendar parts."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tellerframe.functions.ratios import ratio

# ---- fixed values ----------------------------------------------------------
DAYS_PER_YEAR = Decimal("365.25")
DAYS_PER_MONTH = Decimal("30.44")
FIXED_HOLIDAYS = ("01-01", "07-01", "11-11", "12-25", "12-26")


def parse_date(text: Column) -> Column:
    """DATE, or null where the text is no date (a plain cast would raise)."""
    return text.try_cast("date")


def calendar_age(born: Column, as_of: date) -> Column:
    """Completed birthdays; a Feb-29 birth counts from Mar 1 in common years."""
    before_birthday = F.date_format(F.lit(as_of), "MMdd") < F.date_format(born, "MMdd")
    return (F.lit(as_of.year) - F.year(born) - before_birthday.cast("int")).cast("int")


def days_since(day: Column, as_of: date) -> Column:
    return F.datediff(F.lit(as_of), day)


def years_between(days: Column) -> Column:
    """Days as years, one decimal, half up."""
    return ratio(days, F.lit(DAYS_PER_YEAR), 1).cast("decimal(5,1)")


def months_between(days: Column) -> Column:
    """Whole ``days`` as whole average months, half up; negative spans stay negative.  Hundredths of days are
    whole numbers, so nothing is divided as decimals."""
    month = int(DAYS_PER_MONTH * 100)
    # half up: (2 * days + month) / (2 * month), both in hundredths
    months = F.call_function("div", F.abs(days.cast("long")) * 200 + month, F.lit(2 * month).cast("long"))
    return F.when(days < 0, -months).otherwise(months).cast("int")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def transaction_calendar(day: Column) -> dict[str, Column]:
    """Date parts a staged transaction carries."""
    return {
        "txn_year": F.year(day),
        "txn_month": F.month(day),
        "txn_quarter": F.quarter(day),
        "txn_week": F.weekofyear(day),
        "txn_day_of_week": F.date_format(day, "EEEE"),
        "is_weekend": is_weekend(day),
    }


def calendar_attributes(day: Column) -> dict[str, Column]:
    """The attributes of a date-dimension row."""
    quarter = F.quarter(day).cast("string")
    return {
        "date_sk": F.date_format(day, "yyyyMMdd").cast("int"),
        "full_date": day,
        "day_of_week": F.date_format(day, "EEEE"),
        "day_of_week_num": F.dayofweek(day) - 1,
        "day_of_month": F.dayofmonth(day),
        "day_of_year": F.dayofyear(day),
        "week_of_year": F.weekofyear(day),
        "is_weekend": is_weekend(day),
        "month_number": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short": F.date_format(day, "MMM"),
        "first_day_of_month": F.trunc(day, "month"),
        "last_day_of_month": F.last_day(day),
        "quarter": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), quarter),
        "first_day_of_quarter": F.trunc(day, "quarter"),
        "year": F.year(day),
        "fiscal_period": F.concat(F.year(day).cast("string"), F.lit("-Q"), quarter),
        "is_holiday_ca": F.date_format(day, "MM-dd").isin(*FIXED_HOLIDAYS),
    }
