"""Forecasts that adapt: Holt's level and trend, and bounds from the method's own past errors.

A symbol's closes in order are folded into a level and a trend in the JVM, for each weight of a small grid; the weights
with the least squared one-step error are kept (the earlier in the grid on ties). The first two rows start the fold, so a
symbol needs three. Steps are rows: the h-th prediction is h rows after the last one.

A symbol's rows of the lookback window are one array: at most one row a day, so its size is bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The weights that are tried, level first.
WEIGHTS = [(a, b) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.05, 0.2, 0.5)]


def _bound(value: Column, body) -> Column:
    """body(value), where value is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def series(train: DataFrame) -> DataFrame:
    """(symbol, train_rows, first_dt, last_dt, first_close, last_close, status, ys): one row for each symbol."""
    listed = train.groupBy("symbol").agg(
        F.sort_array(F.collect_list(F.struct("ts", "close"))).alias("rows"), F.count(F.lit(1)).alias("train_rows")
    )
    ys = F.transform("rows", lambda r: r["close"])
    finite = F.forall("ys", lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) != float("inf")))
    return listed.withColumn("ys", ys).select(
        "symbol",
        "train_rows",
        F.to_date(F.get("rows", F.lit(0))["ts"]).alias("first_dt"),
        F.to_date(F.element_at("rows", -1)["ts"]).alias("last_dt"),
        F.get("ys", F.lit(0)).alias("first_close"),
        F.element_at("ys", -1).alias("last_close"),
        F.when((F.col("train_rows") >= 3) & finite, "ok").otherwise("skipped").alias("status"),
        "ys",
    )


def _step(state: Column, y: Column, alpha: Column, beta: Column) -> tuple[Column, Column, Column]:
    """Level, trend and squared error after y."""
    guess = state["level"] + state["trend"]
    error = y - guess
    return guess + alpha * error, state["trend"] + alpha * beta * error, state["sse"] + error * error


def _start(ys: Column) -> tuple[Column, Column]:
    first, second = F.get(ys, F.lit(0)), F.get(ys, F.lit(1))
    return second, second - first


def _rest(ys: Column) -> Column:
    return F.slice(ys, F.lit(3), F.greatest(F.size(ys) - 2, F.lit(0)))


def _folded(ys: Column, alpha: Column, beta: Column) -> Column:
    level, trend = _start(ys)

    def merge(state: Column, y: Column) -> Column:
        level, trend, sse = _step(state, y, alpha, beta)
        return F.struct(level.alias("level"), trend.alias("trend"), sse.alias("sse"))

    return F.aggregate(_rest(ys), F.struct(level.alias("level"), trend.alias("trend"), F.lit(0.0).alias("sse")), merge)


def fit(train: DataFrame) -> DataFrame:
    """Series and the best weights with their state: alpha, beta, level, trend, sse. NULL for skipped symbols."""
    grid = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(a).alias("alpha"), F.lit(b).alias("beta")) for i, (a, b) in enumerate(WEIGHTS)])

    def tried(g: Column) -> Column:
        return _bound(
            _folded(F.col("ys"), g["alpha"], g["beta"]),
            lambda s: F.struct(s["sse"].alias("sse"), g["i"].alias("i"), g["alpha"].alias("alpha"), g["beta"].alias("beta"),
                               s["level"].alias("level"), s["trend"].alias("trend")),
        )

    rows = series(train).withColumn("best", F.when(F.col("status") == "ok", F.array_min(F.transform(grid, tried))))
    return rows.select(
        *[c for c in rows.columns if c != "best"], *(F.col(f"best.{c}").alias(c) for c in ("alpha", "beta", "level", "trend", "sse"))
    )


def prediction(h: Column) -> Column:
    return F.col("level") + h * F.col("trend")


def standard_error(h: Column) -> Column:
    """Of the h-th prediction, if one-step errors are independent: past errors enter level and trend."""
    n = h - 1
    alpha, beta = F.col("alpha"), F.col("beta")
    carried = n + beta * n * h + beta * beta * n * h * (2 * h - 1) / 6.0
    return F.sqrt(F.col("sse") / (F.col("train_rows") - 2)) * F.sqrt(1 + alpha * alpha * carried)


def _states(ys: Column, alpha: Column, beta: Column) -> Column:
    """Level and trend after the second row and after each further one."""
    level, trend = _start(ys)
    first = F.struct(level.alias("level"), trend.alias("trend"))
    start = F.struct(level.alias("level"), trend.alias("trend"), F.lit(0.0).alias("sse"), F.array(first).alias("all"))

    def merge(state: Column, y: Column) -> Column:
        level, trend, sse = _step(state, y, alpha, beta)
        return _bound(
            F.struct(level.alias("level"), trend.alias("trend"), sse.alias("sse")),
            lambda s: F.struct(
                s["level"].alias("level"), s["trend"].alias("trend"), s["sse"].alias("sse"),
                F.concat(state["all"], F.array(F.struct(s["level"].alias("level"), s["trend"].alias("trend")))).alias("all"),
            ),
        )

    return F.aggregate(_rest(ys), start, merge, lambda s: s["all"])


def conformal(fitted: DataFrame, horizon: int, interval: float) -> DataFrame:
    """(symbol, h, close_pred, lower_bound, upper_bound, n_errors): bounds without assuming a distribution.

    For each step h the method is asked at every earlier row what comes h rows later; the bound is the
    ceil((n + 1) * interval)-th smallest of the n absolute errors. With too few errors for that rank there is no
    bound (NULL).
    """
    ok = fitted.where(F.col("status") == "ok").withColumn("states", _states(F.col("ys"), F.col("alpha"), F.col("beta")))
    steps = ok.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    # A state that k rows follow the second one was known at row k + 1 and speaks of row k + 1 + h.
    last = F.col("train_rows").cast("int") - 2 - F.col("h")
    origins = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    errors = F.transform(
        origins,
        lambda k: F.abs(
            F.get("ys", k + 1 + F.col("h")) - F.get("states", k)["level"] - F.col("h") * F.get("states", k)["trend"]
        ),
    )
    steps = steps.select(
        "symbol", "h", "last_dt", prediction(F.col("h")).alias("close_pred"), F.sort_array(errors).alias("errors")
    )
    n = F.size("errors")
    rank = F.ceil((n + 1) * F.lit(interval) - F.lit(1e-9)).cast("int")
    width = F.when(rank <= n, F.get("errors", rank - 1))
    return steps.select(
        "symbol",
        "h",
        "last_dt",
        "close_pred",
        (F.col("close_pred") - width).alias("lower_bound"),
        (F.col("close_pred") + width).alias("upper_bound"),
        n.alias("n_errors"),
    )


def coverage(train: DataFrame, horizon: int, interval: float, z: float) -> DataFrame:
    """(h, n_held_out, n_bounded, n_inside, n_inside_normal): the last `horizon` rows of each symbol are held out.

    How many of them lie inside the conformal bounds, and inside those of `z` standard errors, by step.
    """
    whole = series(train).where((F.col("status") == "ok") & (F.col("train_rows") >= horizon + 3))
    n = F.col("train_rows").cast("int") - horizon
    # The rows before the held-out ones, in the columns of a training table.
    kept = whole.select("symbol", F.posexplode(F.slice("ys", F.lit(1), n)).alias("i", "close"))
    kept = kept.select("symbol", F.timestamp_seconds(F.col("i") * 86400).cast("timestamp_ntz").alias("ts"), "close")
    fitted = fit(kept)
    bounds = conformal(fitted, horizon, interval).select("symbol", "h", "close_pred", "lower_bound", "upper_bound")
    errors = fitted.where("status = 'ok'").withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    errors = errors.select("symbol", "h", (z * standard_error(F.col("h"))).alias("margin"))
    held = whole.select("symbol", F.posexplode(F.slice("ys", n + 1, F.lit(horizon))).alias("i", "actual"))
    held = held.select("symbol", (F.col("i") + 1).alias("h"), "actual")
    both = held.join(bounds, ["symbol", "h"]).join(errors, ["symbol", "h"])
    return both.groupBy("h").agg(
        F.count(F.lit(1)).alias("n_held_out"),
        F.count("lower_bound").alias("n_bounded"),
        F.count_if(F.col("actual").between(F.col("lower_bound"), F.col("upper_bound"))).alias("n_inside"),
        F.count_if(F.abs(F.col("actual") - F.col("close_pred")) <= F.col("margin")).alias("n_inside_normal"),
    )
