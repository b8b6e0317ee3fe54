"""Date and time arithmetic with the semantics the analyses need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.functions.columns import as_column


def minutes_between(start, end) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (18:05:58 -> 18:06:02 is 1).

    This is the ``DATEDIFF(MINUTE, a, b)`` rule of the source system. It is computed
    from the dates and wall-clock times, never through an instant, so a session zone
    with daylight saving does not move it.
    """
    minute_of_day = lambda t: F.hour(t) * 60 + F.minute(t)
    a, b = as_column(start), as_column(end)
    return (F.datediff(b, a) * 1440 + minute_of_day(b) - minute_of_day(a)).cast("int")


def days_between(start, end) -> Column:
    """Whole days ``end - start`` as an int (Spark's ``d1 - d2`` is an interval)."""
    return F.datediff(as_column(end), as_column(start))


def month_key(col) -> Column:
    """'yyyy-MM' month label (upper-case MM: lower-case mm would be minutes)."""
    return F.date_format(as_column(col), "yyyy-MM")


def iso_weekday(col) -> Column:
    """Monday = 1 ... Sunday = 7 (Spark's ``dayofweek`` has Sunday = 1)."""
    return ((F.dayofweek(as_column(col)) + 5) % 7 + 1).cast("int")


def week_of_year_block(col, days: int = 7) -> Column:
    """Index of the ``days``-long block of the year a date falls in, counted from
    1 January (not ISO weeks): ``ceil(dayofyear / days)``."""
    return F.ceil(F.dayofyear(as_column(col)) / F.lit(days)).cast("int")
