"""KPIs of any range of days from parts by month.

A part has what merging needs: the first and the last close with their days, and count, mean and sum of squared
deviations of the daily returns. A range takes the parts of the months that lie inside it and the bars of the (at most
two) months that it cuts, so years cost months and not days.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailybars.functions.prices import daily_return_pct
from dailybars.operators.bars import stage_bars


def month_parts(bars: DataFrame) -> DataFrame:
    """(symbol, month_dt) and the part; one aggregate, combined before its shuffle."""
    change = F.when(~F.isnan("open"), daily_return_pct())
    rows = stage_bars(bars).select("symbol", "dt", "close", change.alias("change"))
    parts = rows.groupBy("symbol", F.trunc("dt", "month").alias("month_dt")).agg(
        F.min("dt").alias("first_dt"),
        F.min_by("close", "dt").alias("first_close"),
        F.max("dt").alias("last_dt"),
        F.max_by("close", "dt").alias("last_close"),
        F.count("change").alias("n"),
        F.avg("change").alias("mean"),
        F.var_pop("change").alias("m2"),
    )
    return parts.withColumn("m2", F.col("m2") * F.col("n"))


def _merged(state: Column, part: Column) -> Column:
    """Count, mean and squared deviations of both together."""
    n = state["n"] + part["n"]
    delta = part["mean"] - state["mean"]
    both = F.struct(
        n.alias("n"),
        (state["mean"] + delta * part["n"] / n).alias("mean"),
        (state["m2"] + part["m2"] + delta * delta * state["n"] * part["n"] / n).alias("m2"),
    )
    return F.when(part["n"] == 0, state).when(state["n"] == 0, part).otherwise(both)


def kpis(parts: DataFrame) -> DataFrame:
    """One row for each symbol. Its parts, one for each month of the calendar at most, are merged in order."""
    moments = F.struct(F.col("n").cast("double").alias("n"), F.col("mean"), F.col("m2"))
    ends = parts.groupBy("symbol").agg(
        F.min("first_dt").alias("first_dt"),
        F.max("last_dt").alias("last_dt"),
        F.min_by("first_close", "first_dt").alias("first_close"),
        F.max_by("last_close", "last_dt").alias("last_close"),
        F.sort_array(F.collect_list(F.struct("first_dt", moments.alias("m")))).alias("parts"),
    )
    nothing = F.struct(F.lit(0.0).alias("n"), F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("m2"))
    whole = ends.withColumn("m", F.aggregate("parts", nothing, lambda state, part: _merged(state, part["m"])))
    change = F.try_divide(F.col("last_close"), F.col("first_close")) - F.lit(1)
    return whole.select(
        "symbol", "first_dt", "last_dt", "first_close", "last_close",
        (change * F.lit(100)).alias("total_return_pct"),
        F.when(F.col("m.n") > 1, F.sqrt(F.col("m.m2") / (F.col("m.n") - 1))).alias("volatility"),
    )


def _month_after(day: date) -> date:
    return (day.replace(day=1) + timedelta(days=32)).replace(day=1)


def whole_months(start: date, end: date) -> tuple[date, date] | None:
    """First and last month (by their first day) that lie inside [start, end]."""
    first = start if start.day == 1 else _month_after(start)
    # The month of the day after the end is the first that is not whole.
    last = ((end + timedelta(days=1)).replace(day=1) - timedelta(days=1)).replace(day=1)
    return (first, last) if first <= last else None


def range_kpis(bars_between, parts: DataFrame, start: date, end: date) -> DataFrame:
    """KPIs of [start, end]. ``bars_between(since, until)`` reads bars; it is asked for the cut months only."""
    inside = whole_months(start, end)
    if inside is None:
        return kpis(month_parts(bars_between(start, end)))
    first, last = inside
    chosen = parts.where(F.col("month_dt").between(F.lit(first), F.lit(last)))
    after = _month_after(last)
    for since, until in ((start, first - timedelta(days=1)), (after, end)):
        if since <= until:
            chosen = chosen.unionByName(month_parts(bars_between(since, until)).select(*parts.columns))
    return kpis(chosen)
