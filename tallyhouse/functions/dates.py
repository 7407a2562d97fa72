"""Calendar expressions with fixed, engine-independent meaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyhouse.functions.clean import ColumnLike, as_col


def grain(c: ColumnLike, unit: str) -> Column:
    """First day of the day/week/month/quarter/year (weeks start on Monday)."""
    return F.to_date(F.date_trunc(unit, as_col(c)))


def days_between(start: ColumnLike, end: ColumnLike) -> Column:
    return F.datediff(as_col(end), as_col(start))


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Hour boundaries crossed from start to end (10:59 → 11:01 is 1)."""
    begin = F.unix_timestamp(F.date_trunc("hour", as_col(start)))
    stop = F.unix_timestamp(F.date_trunc("hour", as_col(end)))
    return ((stop - begin) / 3600).cast("long")


def month_days(month_start: ColumnLike) -> Column:
    """Days in the month that starts on the given date."""
    first = as_col(month_start)
    return F.datediff(F.add_months(first, 1), first)
