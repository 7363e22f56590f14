"""What the dashboard and the sample queries ask for."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.functions.prices import daily_return_pct
from dailybars.operators.asof import asof_join


def _priced(bars: DataFrame) -> DataFrame:
    """Rows with a close; NaN is none."""
    return bars.where(F.col("close").isNotNull() & ~F.isnan("close"))


def _between(bars: DataFrame, start: date | None, end: date | None) -> DataFrame:
    if start is not None:
        bars = bars.where(F.col("dt") >= F.lit(start))
    if end is not None:
        bars = bars.where(F.col("dt") <= F.lit(end))
    return bars


def latest_price(bars: DataFrame) -> DataFrame:
    return (
        _priced(bars)
        .groupBy("symbol")
        .agg(F.max("dt").alias("dt"), F.max_by("close", "dt").alias("close"))
    )


def total_return(bars: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Last close against first close in [start, end], in percent."""
    ends = (
        _priced(_between(bars, start, end))
        .groupBy("symbol")
        .agg(
            F.min("dt").alias("first_dt"),
            F.max("dt").alias("last_dt"),
            F.min_by("close", "dt").alias("first_close"),
            F.max_by("close", "dt").alias("last_close"),
        )
    )
    change = F.try_divide(F.col("last_close"), F.col("first_close")) - F.lit(1)
    return ends.withColumn("total_return_pct", change * F.lit(100))


def volatility(bars: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Sample deviation of the daily return; days without an open (NaN is none) have no return."""
    there = F.when(~F.isnan("open"), daily_return_pct())
    return (
        _priced(_between(bars, start, end))
        .groupBy("symbol")
        .agg(F.stddev_samp(there).alias("volatility"))
    )


def latest_rows(summary: DataFrame, symbol: str, n: int = 30) -> DataFrame:
    """The newest ``n`` rows of one symbol (a top-n report)."""
    return summary.where(F.col("symbol") == F.lit(symbol)).orderBy(F.col("dt").desc()).limit(n)


def actual_and_predicted(final: DataFrame, symbol: str | None = None) -> DataFrame:
    """Actuals and forecasts, newest first; a distributed sort."""
    rows = final if symbol is None else final.where(F.col("symbol") == F.lit(symbol))
    return rows.orderBy(F.col("dt").desc())


def prediction_errors(bars: DataFrame, predictions: DataFrame) -> DataFrame:
    """Each actual close with the newest prediction for its day that was made before that day; NULL without one.

    ``predictions`` may hold many for a day, made at different times (``forecast_archive``).
    """
    actual = _priced(bars).select("symbol", "dt", "close", F.col("dt").cast("timestamp_ntz").alias("day"))
    made = predictions.select(
        "symbol", F.col("prediction_for").alias("dt"), "close_pred", "lower_bound", "upper_bound", "created_at"
    )
    error = F.col("close") - F.col("close_pred")
    return asof_join(actual, made, ["symbol", "dt"], "day", "created_at").select(
        "symbol",
        "dt",
        "close",
        "close_pred",
        "created_at",
        error.alias("error"),
        (F.try_divide(error, F.col("close")) * F.lit(100)).alias("error_pct"),
        F.col("close").between(F.col("lower_bound"), F.col("upper_bound")).alias("inside"),
    )
