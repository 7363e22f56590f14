"""Price expressions on one bar, and the row frames over a symbol's bars."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def daily_range() -> Column:
    return F.col("high") - F.col("low")


def daily_return_pct() -> Column:
    """Return within the day in percent; NULL where the open is zero."""
    return F.try_divide(F.col("close") - F.col("open"), F.col("open")) * F.lit(100)


def last_rows(n: int) -> WindowSpec:
    """The current bar and the n-1 bars before it: rows, not calendar days.

    One symbol is one window group. Its size is bounded by the calendar, because (symbol, dt) is a
    key and dt is a date: a century of trading days is about 25,000 rows however many ticks or
    symbols there are.
    """
    return Window.partitionBy("symbol").orderBy("dt").rowsBetween(-(n - 1), Window.currentRow)


def moving_average(column: str, n: int) -> Column:
    return F.avg(column).over(last_rows(n))


def rolling_volatility(n: int) -> Column:
    return F.stddev_samp(daily_return_pct()).over(last_rows(n))


def key_text() -> Column:
    """Symbol and date as one text, the unique key of the history table."""
    return F.concat(F.col("symbol"), F.col("dt").cast("string"))
