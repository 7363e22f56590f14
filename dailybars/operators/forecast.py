"""Forecasts of the close for all symbols at once, and the table of actuals and forecasts.

Training is one aggregation per symbol, forecasting a projection over its result: no per-symbol
job, no Python in the tasks. Three methods:

trend   straight line through the closes, x = days since the first training day
        pred = a + b x;  se = s sqrt(1 + 1/n + (x - mean_x)^2 / Sxx);  s^2 = (Syy - Sxy^2/Sxx)/(n-2)
drift   the last close carried on by the mean step
        pred = y_n + h d;  se = s sqrt(h (1 + h/(n-1)));  s = sample deviation of the steps
holt    level and trend that follow the closes (see holt.py)

Bounds are pred -/+ z se, z being the normal quantile of the prediction interval.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailybars import schemas
from dailybars.functions.times import moment
from dailybars.operators import holt
from dailybars.operators.bars import lookback

MIN_TRAIN_ROWS = 3


def train_rows(bars: DataFrame, as_of: date, lookback_days: int) -> DataFrame:
    """(symbol, ts, close) of the lookback window, without missing closes."""
    return (
        lookback(bars, as_of, lookback_days)
        .where(F.col("close").isNotNull() & ~F.isnan("close"))
        .select("symbol", F.col("dt").cast("timestamp_ntz").alias("ts"), "close")
    )


def keep_other_symbols(
    existing: DataFrame, fresh: DataFrame, symbols: Iterable[str] | None
) -> DataFrame:
    """Fresh rows replace those of the symbols of this run; other symbols keep theirs."""
    if symbols is None:
        return fresh
    others = existing.where(~F.col("symbol").isin(list(symbols)))
    return others.unionByName(fresh.select(*existing.columns))


def as_models(fitted: DataFrame) -> DataFrame:
    """In the columns of the stored models; what a method does not have is NULL."""
    return fitted.select(
        *(F.col(f.name) if f.name in fitted.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.MODELS)
    )


def train_counts(train: DataFrame) -> DataFrame:
    return train.groupBy("symbol").agg(F.count(F.lit(1)).alias("train_rows"))


def fit(train: DataFrame, with_steps: bool = True) -> DataFrame:
    """Parameters of both methods per symbol; ``with_steps=False`` leaves out the steps' deviation.

    The day number is taken from a fixed day and moved to the symbol's first day afterwards, which
    saves a pass over the data; centred sums do not depend on the origin. Without the steps all is
    combined before the shuffle. The steps need the rows of a symbol in order: a window over its
    lookback window, at most one row per day.
    """
    day_number = F.date_diff(F.to_date("ts"), F.lit(date(1970, 1, 1))).cast("double")
    step = F.lit(None).cast("double")
    if with_steps:
        step = F.col("close") - F.lag("close").over(Window.partitionBy("symbol").orderBy("ts"))
    numbered = train.select("symbol", "ts", "close", day_number.alias("x"), step.alias("step"))
    fitted = numbered.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.to_date(F.min("ts")).alias("first_dt"),
        F.to_date(F.max("ts")).alias("last_dt"),
        F.min_by("close", "ts").alias("first_close"),
        F.max_by("close", "ts").alias("last_close"),
        F.min("x").alias("first_x"),
        F.avg("x").alias("abs_mean_x"),
        F.avg("close").alias("mean_y"),
        F.regr_sxx("close", "x").alias("sxx"),
        F.regr_sxy("close", "x").alias("sxy"),
        F.regr_syy("close", "x").alias("syy"),
        F.stddev_samp("step").alias("step_sd"),
    )
    # An infinite close makes the sums NaN or infinite; neither can be forecast from.
    finite = F.abs("sxy") + F.abs("syy") + F.abs("mean_y") < F.lit(float("inf"))
    enough = (F.col("train_rows") >= MIN_TRAIN_ROWS) & (F.col("sxx") > 0) & finite
    slope = F.try_divide(F.col("sxy"), F.col("sxx"))
    mean_x = F.col("abs_mean_x") - F.col("first_x")
    step = F.try_divide(F.col("last_close") - F.col("first_close"), F.col("train_rows") - 1)
    return fitted.select(
        "symbol",
        "train_rows",
        "first_dt",
        "last_dt",
        "first_close",
        "last_close",
        F.when(enough, "ok").otherwise("skipped").alias("status"),
        slope.alias("slope"),
        (F.col("mean_y") - slope * mean_x).alias("intercept"),
        mean_x.alias("mean_x"),
        "sxx",
        "sxy",
        "syy",
        step.alias("step"),
        "step_sd",
    )


def normal_quantile(prediction_interval: float) -> float:
    return NormalDist().inv_cdf(0.5 + prediction_interval / 2)


def _next_day(h: Column, business_days: bool) -> Column:
    """The h-th day after the last training day, counting every day or Monday to Friday only."""
    last = F.col("last_dt")
    if not business_days:
        return F.date_add(last, h)
    weekday = F.weekday(last)  # Monday is 0
    past_friday = F.greatest(weekday - 4, F.lit(0))
    weekends = F.floor((weekday - past_friday + h) / 5).cast("int")
    return F.date_add(F.date_sub(last, past_friday), h + 2 * weekends)


def forecast(
    models: DataFrame,
    horizon_days: int,
    prediction_interval: float,
    created_at: datetime,
    method: str = "trend",
    business_days: bool = False,
) -> DataFrame:
    """``horizon_days`` rows for every symbol that trained."""
    steps = models.where(F.col("status") == "ok").withColumn(
        "h", F.explode(F.sequence(F.lit(1), F.lit(horizon_days)))
    )
    steps = steps.withColumn("prediction_for", _next_day(F.col("h"), business_days))
    n, h = F.col("train_rows"), F.col("h")
    if method == "trend":
        x = F.date_diff("prediction_for", "first_dt").cast("double")
        pred = F.col("intercept") + F.col("slope") * x
        residual = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx"), F.lit(0.0))
        off_centre = x - F.col("mean_x")
        spread = F.lit(1.0) + F.lit(1.0) / n + off_centre * off_centre / F.col("sxx")
        error = F.sqrt(residual / (n - 2)) * F.sqrt(spread)
    elif method == "holt":
        pred, error = holt.prediction(h), holt.standard_error(h)
    elif method == "drift":
        pred = F.col("last_close") + h * F.col("step")
        error = F.col("step_sd") * F.sqrt(h * (F.lit(1.0) + h / (n - 1)))
    else:
        raise ValueError(f"unknown method {method!r}")
    margin = F.lit(normal_quantile(prediction_interval)) * error
    return steps.select(
        "symbol",
        F.col("prediction_for").cast("timestamp_ntz").alias("ts"),
        pred.alias("close_pred"),
        (pred - margin).alias("lower_bound"),
        (pred + margin).alias("upper_bound"),
        "prediction_for",
        moment(created_at).alias("created_at"),
    )


def from_as_of(forecasts: DataFrame, as_of: date) -> DataFrame:
    return forecasts.where(F.col("prediction_for") >= F.lit(as_of))


def pred_counts(forecasts: DataFrame, as_of: date) -> DataFrame:
    return from_as_of(forecasts, as_of).groupBy("symbol").agg(F.count(F.lit(1)).alias("pred_rows"))


def outcomes(
    models: DataFrame, forecasts: DataFrame, as_of: date, requested: DataFrame | None = None
) -> DataFrame:
    """What became of every symbol in training and in forecasting; one symbol's failure stops no other.

    ``requested`` (symbol) adds the symbols that have no bar at all in the training window.
    """
    models = models.select("symbol", "status", "train_rows", "first_dt", "last_dt")
    if requested is not None:
        models = requested.select("symbol").distinct().join(models, "symbol", "left")
        models = models.fillna({"status": "skipped", "train_rows": 0})
    n = F.col("train_rows")
    ok = F.col("status") == "ok"
    trained = models.select(
        "symbol",
        F.lit("train").alias("stage"),
        "status",
        n.alias("n_rows"),
        F.when(ok, F.concat(F.lit("ok (train_rows="), n.cast("string"), F.lit(")")))
        .when(n < MIN_TRAIN_ROWS, F.concat(F.lit("skipped: too few rows ("), n.cast("string"), F.lit(")")))
        .when(F.col("first_dt") < F.col("last_dt"), F.lit("skipped: a close is not finite"))
        .otherwise(F.lit("skipped: all rows on one day"))
        .alias("message"),
    )
    counted = models.select("symbol", "status").join(pred_counts(forecasts, as_of), "symbol", "left")
    made = F.coalesce("pred_rows", F.lit(0).cast("bigint"))
    predicted = counted.select(
        "symbol",
        F.lit("forecast").alias("stage"),
        "status",
        made.alias("n_rows"),
        F.when(ok, F.concat(F.lit("ok (pred_rows="), made.cast("string"), F.lit(")")))
        .otherwise(F.lit("skipped: no model"))
        .alias("message"),
    )
    return trained.unionByName(predicted)


def final_table(
    bars: DataFrame, forecasts: DataFrame, as_of: date, lookback_days: int, created_at: datetime
) -> DataFrame:
    """Actuals of the lookback window (missing closes included) and the predictions from ``as_of`` on."""
    stamp = moment(created_at).alias("created_at")
    no_double = F.lit(None).cast("double")
    actual = lookback(bars, as_of, lookback_days).select(
        *schemas.BAR_COLUMNS,
        F.lit("RAW").alias("source"),
        no_double.alias("close_forecast"),
        no_double.alias("upper_bound_forecast"),
        no_double.alias("lower_bound_forecast"),
        stamp,
    )
    predicted = from_as_of(forecasts, as_of).select(
        "symbol",
        F.col("prediction_for").alias("dt"),
        *(no_double.alias(name) for name in schemas.PRICE_COLUMNS),
        F.lit(None).cast("bigint").alias("volume"),
        F.lit("FORECAST").alias("source"),
        F.col("close_pred").alias("close_forecast"),
        F.col("upper_bound").alias("upper_bound_forecast"),
        F.col("lower_bound").alias("lower_bound_forecast"),
        stamp,
    )
    return actual.unionByName(predicted)


# Bound names of the older table layout. The first one carries the upper bound.
LEGACY_NAMES = {
    "upper_bound_forecast": "open_bound_forecast",
    "lower_bound_forecast": "lowerbound_forecast",
}


def legacy_names(final: DataFrame) -> DataFrame:
    return final.withColumnsRenamed(LEGACY_NAMES)


def forecast_sql(prediction_interval: float = 0.95) -> str:
    """Trend or Holt predictions of the symbol ``wanted`` for ``horizon`` days, as SQL over ``{models}``."""
    z = repr(normal_quantile(prediction_interval))
    return f"""
  WITH m AS (
    SELECT *, date_add(last_dt, h) AS day, CAST(date_diff(date_add(last_dt, h), first_dt) AS DOUBLE) AS x
    FROM {{models}} LATERAL VIEW explode(sequence(1, greatest(horizon, 1))) steps AS h
    WHERE symbol = wanted AND status = 'ok' AND h <= horizon),
  p AS (
    SELECT symbol, day, CASE WHEN level IS NULL THEN intercept + slope * x ELSE level + h * trend END AS pred,
      CASE WHEN level IS NULL
        THEN sqrt(greatest(syy - sxy * sxy / sxx, 0D) / (train_rows - 2))
             * sqrt(1 + 1D / train_rows + (x - mean_x) * (x - mean_x) / sxx)
        ELSE sqrt(sse / (train_rows - 2)) * sqrt(1 + alpha * alpha
             * (h - 1 + beta * (h - 1) * h + beta * beta * (h - 1) * h * (2 * h - 1) / 6D)) END AS se
    FROM m)
  SELECT symbol, day, pred, pred - {z}D * se, pred + {z}D * se FROM p"""
