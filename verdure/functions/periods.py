"""Date windows counted back from an as-of date.

The rolling windows include both ends, and the upper end is midnight of the
as-of date: a sale later on that day is outside. Bounds are cast to the type
of the column, never the other way round, so they reach the Parquet scan as
pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.date | str | None


def as_of_date(as_of: AsOf = None) -> Column:
    """The as-of date as a column; today where none is given."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, str):
        as_of = dt.date.fromisoformat(as_of)
    return F.lit(as_of)


def year_column(column: str) -> str:
    """Name of the partition column that stored copies carry for ``column``."""
    return f"{column}_year"


def _rolling(as_of: AsOf, months: int) -> tuple[Column, Column]:
    day = as_of_date(as_of)
    return F.add_months(day, -months), day


def _year_bounds(as_of: AsOf, calendar: bool) -> tuple[Column, Column]:
    if not calendar:
        return _rolling(as_of, 12)
    start = F.trunc(as_of_date(as_of), "year")
    return F.add_months(start, -12), start


def _month_bounds(as_of: AsOf, calendar: bool) -> tuple[Column, Column]:
    if not calendar:
        return _rolling(as_of, 1)
    start = F.trunc(as_of_date(as_of), "month")
    return start, F.add_months(start, 1)


#: Windows of the reports by name, for ``window_start``.
WINDOWS = ("year", "month", "calendar year", "calendar month")


def window_start(as_of: AsOf, window: str) -> Column:
    """First day of a window: nothing before it can be in a report over that window."""
    if window not in WINDOWS:
        raise ValueError(f"unknown window: {window}")
    bounds = _year_bounds if window.endswith("year") else _month_bounds
    return bounds(as_of, window.startswith("calendar"))[0]


def _in_years(df: DataFrame, column: str, bounds: tuple[Column, Column]) -> DataFrame:
    """Prune stored years outside the bounds; rows without a known year stay."""
    if year_column(column) not in df.columns:
        return df
    lower, upper = bounds
    year = F.col(year_column(column))
    return df.where(year.isNull() | year.between(F.year(lower), F.year(upper)))


def _between(
    df: DataFrame, column: str, bounds: tuple[Column, Column], calendar: bool
) -> DataFrame:
    kind = df.schema[column].dataType
    low, high = (bound.cast(kind) for bound in bounds)
    value = F.col(column)
    inside = (value >= low) & (value < high if calendar else value <= high)
    return _in_years(df, column, bounds).where(inside)


def within_last_year(
    df: DataFrame, column: str, as_of: AsOf = None, calendar: bool = False
) -> DataFrame:
    """Rows of the year up to the as-of date, or of the calendar year before it."""
    return _between(df, column, _year_bounds(as_of, calendar), calendar)


def within_last_month(
    df: DataFrame, column: str, as_of: AsOf = None, calendar: bool = False
) -> DataFrame:
    """Rows of the month up to the as-of date, or of the calendar month it lies in."""
    return _between(df, column, _month_bounds(as_of, calendar), calendar)


def stored_last_year(
    df: DataFrame, column: str, as_of: AsOf = None, calendar: bool = False
) -> DataFrame:
    """Rows that may belong to ``within_last_year`` by the year they are stored under.

    For tables without the date itself, such as the lines of orders: a cheap
    cut of the scan before the exact join with the dated table.
    """
    return _in_years(df, column, _year_bounds(as_of, calendar))


def stored_last_month(
    df: DataFrame, column: str, as_of: AsOf = None, calendar: bool = False
) -> DataFrame:
    """Rows that may belong to ``within_last_month`` by the year they are stored under."""
    return _in_years(df, column, _month_bounds(as_of, calendar))
