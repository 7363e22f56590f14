"""Bars in parts: what a delivery of ticks says about a day, and how such parts merge.

A partial bar has the first and the last order key with their prices, high, low and the number of ticks. Merging is
associative and commutative, so deliveries may come in any order and a late tick restates its day without the other
ticks of that day. Parts are kept by delivery: one that is delivered again takes its own place and counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partial_bars(ticks: DataFrame, symbol: str | Column, ts: str, price: str, order: str) -> DataFrame:
    """(symbol, dt) and the parts. ``order`` is a whole number, unique within a symbol and day over all deliveries.

    A tick without a symbol, time, price (NaN is none) or order says nothing about a bar and is left out.
    """
    column = F.col(symbol) if isinstance(symbol, str) else symbol
    rows = ticks.select(
        column.cast("string").alias("symbol"),
        F.to_date(ts).alias("dt"),
        F.col(price).cast("double").alias("price"),
        F.col(order).cast("long").alias("at"),
    )
    there = F.col("symbol").isNotNull() & F.col("dt").isNotNull() & F.col("at").isNotNull()
    rows = rows.where(there & F.col("price").isNotNull() & ~F.isnan("price"))
    return rows.groupBy("symbol", "dt").agg(
        F.min("at").alias("first_at"),
        F.min_by("price", "at").alias("first_price"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max("at").alias("last_at"),
        F.max_by("price", "at").alias("last_price"),
        F.count(F.lit(1)).alias("n"),
    )


def merged(parts: DataFrame) -> DataFrame:
    """One part for each (symbol, dt); combined before the shuffle."""
    return parts.groupBy("symbol", "dt").agg(
        F.min("first_at").alias("first_at"),
        F.min_by("first_price", "first_at").alias("first_price"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max("last_at").alias("last_at"),
        F.max_by("last_price", "last_at").alias("last_price"),
        F.sum("n").alias("n"),
    )


def bars_of(parts: DataFrame) -> DataFrame:
    return merged(parts).select(
        "symbol",
        "dt",
        F.col("first_price").alias("open"),
        "high",
        "low",
        F.col("last_price").alias("close"),
        F.col("n").cast("bigint").alias("volume"),
    )

