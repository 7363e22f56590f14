"""Daily price-bar analytics on Spark: ingest, upsert, indicators, forecasts, checks, history."""

from dailybars.settings import Settings

__all__ = ["Settings"]
