"""Staging filters, indicators and the summary."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars import schemas
from dailybars.functions.prices import daily_range, daily_return_pct, moving_average, rolling_volatility

# Row counts of the two moving averages and of the rolling deviation.
SHORT_ROWS = 7
LONG_ROWS = 30


def stage_bars(bars: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """The seven bar columns of rows that have a day and a close (NaN is none), for any set of symbols."""
    there = F.col("dt").isNotNull() & F.col("close").isNotNull() & ~F.isnan("close")
    staged = bars.select(*schemas.BAR_COLUMNS).where(there)
    return staged if symbols is None else staged.where(F.col("symbol").isin(list(symbols)))


def lookback(bars: DataFrame, as_of: date, days: int) -> DataFrame:
    """Bars of the last ``days`` days; no upper limit."""
    return bars.where(F.col("dt") >= F.date_sub(F.lit(as_of), days))


def summary(bars: DataFrame, symbols: Iterable[str] | None = None) -> DataFrame:
    """Staged bars with range, return and both moving averages.

    Both frames share partitioning and order, so Spark plans one shuffle, one sort, one window.
    """
    return stage_bars(bars, symbols).select(
        *schemas.BAR_COLUMNS,
        daily_range().alias("daily_range"),
        daily_return_pct().alias("daily_return_pct"),
        moving_average("close", SHORT_ROWS).alias("ma_7_day"),
        moving_average("close", LONG_ROWS).alias("ma_30_day"),
    )


def rolling_deviation(bars: DataFrame, rows: int = LONG_ROWS) -> DataFrame:
    """Sample deviation of the daily return over the last ``rows`` bars."""
    return stage_bars(bars).select("symbol", "dt", rolling_volatility(rows).alias("volatility_30_day"))


def rows_per_symbol(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"))
