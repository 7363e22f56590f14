"""Daily bars from finer ticks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bars(
    ticks: DataFrame,
    symbol: str | Column,
    ts: str,
    price: str,
    order: str,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """One bar per symbol and day; days in [start, end). Volume is the number of ticks.

    ``order`` names a column that is unique within a symbol and day and says which tick came first;
    uniqueness makes open and close the same on every run. A single fixed-width column (not a
    struct) keeps this a hash aggregate. Ticks are combined before the shuffle, so a task sends at
    most one row per symbol and day, and a symbol that holds most ticks makes no large group. The
    date limits go down to the scan as limits on ``ts``.
    """
    day = F.to_date(ts)
    if start is not None:
        ticks = ticks.where(day >= F.lit(start))
    if end is not None:
        ticks = ticks.where(day < F.lit(end))
    column = F.col(symbol) if isinstance(symbol, str) else symbol
    return (
        ticks.groupBy(column.cast("string").alias("symbol"), day.alias("dt"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.count(F.lit(1)).alias("volume"),
        )
        .select("symbol", "dt", "open", "high", "low", "close", "volume")
    )
