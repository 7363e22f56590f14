"""Stored bars -> models -> forecasts -> table of actuals and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailybars.operators import forecast as fc
from dailybars.operators import holt
from dailybars.operators.merge import replace_forecasts
from dailybars.plans.etl import requested_symbols
from dailybars.settings import Settings
from dailybars.sources.tables import TableStore


def _bars(store: TableStore, settings: Settings) -> DataFrame:
    bars = store.read("raw_bars", since=settings.train_start)
    if settings.symbols is None:
        return bars
    return bars.where(F.col("symbol").isin(list(settings.symbols)))


def _models(store: TableStore, settings: Settings) -> DataFrame:
    models = store.read("models")
    if settings.symbols is None:
        return models
    return models.where(F.col("symbol").isin(list(settings.symbols)))


def run_training(store: TableStore, settings: Settings) -> DataFrame:
    """Fit every symbol and keep the parameters."""
    train = fc.train_rows(_bars(store, settings), settings.as_of, settings.train_lookback_days)
    if settings.method == "holt":
        fitted = holt.fit(train)
    else:
        fitted = fc.fit(train, with_steps=settings.method == "drift")
    models = fc.keep_other_symbols(store.read("models"), fc.as_models(fitted), settings.symbols)
    store.overwrite("models", models)
    return _models(store, settings)


def run_forecast(store: TableStore, settings: Settings) -> DataFrame:
    """Train, replace the predictions from ``as_of`` on, rebuild the final table; per-symbol outcomes."""
    store.ensure(["raw_bars", "models", "forecasts", "final"])
    models = run_training(store, settings)
    fresh = fc.forecast(
        models,
        settings.horizon_days,
        settings.prediction_interval,
        settings.run_ts,
        settings.method,
        settings.business_days,
    )
    if settings.keep_predictions:
        store.upsert("forecast_archive", fresh)
    # Predictions start after the last training day, which may lie some days before the run date.
    earliest = models.where(F.col("status") == "ok").agg(F.min("last_dt")).first()[0]
    if earliest is not None:
        store.rewrite_from(
            "forecasts",
            min(earliest, settings.as_of),
            lambda existing: replace_forecasts(
                existing, fresh, settings.as_of, models if settings.strict_replace else None
            ),
        )
    forecasts = store.read("forecasts", since=settings.as_of)
    if settings.symbols is not None:
        forecasts = forecasts.where(F.col("symbol").isin(list(settings.symbols)))
    final = fc.final_table(
        _bars(store, settings), forecasts, settings.as_of, settings.train_lookback_days, settings.run_ts
    )
    store.replace_symbols("final", settings.symbols, final)
    requested = requested_symbols(store.spark, settings)
    store.overwrite("forecast_outcomes", fc.outcomes(models, forecasts, settings.as_of, requested))
    return store.read("forecast_outcomes")


def register_forecast_function(store: TableStore, name: str = "forecast_of") -> None:
    """An SQL table function over the stored models: ``SELECT * FROM forecast_of('AAPL', 14)``.

    It predicts with the method that each model was trained for, every day, like a run without business days. Bounds
    are those of the default interval.
    """
    predicted = fc.forecast_sql()
    store.ensure(["models"])
    store.spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted STRING, horizon INT) "
        "RETURNS TABLE (symbol STRING, prediction_for DATE, close_pred DOUBLE, lower_bound DOUBLE, upper_bound DOUBLE) "
        f"RETURN {predicted.format(models=store.full_name('models'))}"
    )
