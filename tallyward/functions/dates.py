"""Date functions. "Today" is always an argument, never read from the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATETIME_FORMAT = "y-M-d H:m"
DATE_FORMAT = "y-M-d"
NO_MONTH = "NA-NA"


def parse_datetime(col: Column, fmt: str = DATETIME_FORMAT) -> Column:
    """Text to timestamp; text that does not fit becomes null, also under ANSI."""
    return F.try_to_timestamp(col, F.lit(fmt))


def parse_date(col: Column, fmt: str = DATE_FORMAT) -> Column:
    """Year-month-day text, zero-padded or not, to date; null if it does not fit.

    Years of two digits are not guessed at: they do not fit.
    """
    date = F.try_to_date(col, fmt)
    return F.when(F.year(date) >= 100, date)


def date_parts(col: Column) -> dict[str, Column]:
    """Year, month, day and time of day as zero-padded text columns."""
    return {
        "year": F.date_format(col, "yyyy"),
        "month": F.date_format(col, "MM"),
        "day": F.date_format(col, "dd"),
        "time": F.date_format(col, "HH:mm:ss"),
    }


def month_key(col: Column) -> Column:
    """``yyyy-MM``; undated rows share the key ``NA-NA``."""
    return F.coalesce(F.date_format(col, "yyyy-MM"), F.lit(NO_MONTH))


def month_label(col: Column, year_in_month: int = 3) -> Column:
    """Short month name, with the year added in one month of the year; null if undated."""
    return F.when(
        F.month(col) == year_in_month, F.date_format(col, "MMM yyyy")
    ).otherwise(F.date_format(col, "MMM"))


def date_text(col: Column) -> Column:
    """A date in words, e.g. ``March 01, 2019``."""
    return F.date_format(col, "MMMM dd, yyyy")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``."""
    return F.datediff(later, earlier)
