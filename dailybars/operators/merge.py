"""Row-level merge, replace and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailybars import schemas


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str] = tuple(schemas.KEY)) -> DataFrame:
    """Target rows whose key is not in the source, plus every source row.

    That is update-or-insert when the source has one row per key. The anti join needs the source's
    keys only; Spark broadcasts them when their size allows, and then the target is not shuffled.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def latest_per_key(
    rows: DataFrame, order_by: str, keys: Sequence[str] = tuple(schemas.KEY)
) -> DataFrame:
    """One row per key, the one with the greatest ``order_by``.

    An aggregate, not a ranking: copies are combined before the shuffle, so a key with very many
    copies stays one small buffer.
    """
    values = [name for name in rows.columns if name not in keys and name != order_by]
    latest = rows.groupBy(*keys).agg(
        *(F.max_by(name, order_by).alias(name) for name in values), F.max(order_by).alias(order_by)
    )
    return latest.select(*rows.columns)


def duplicate_keys(rows: DataFrame, keys: Sequence[str] = tuple(schemas.KEY)) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def without(rows: DataFrame, predicate: Column) -> DataFrame:
    """Delete by predicate: rows for which it is unknown stay, as in SQL."""
    return rows.where(~F.coalesce(predicate, F.lit(False)))


def replace_forecasts(
    existing: DataFrame, fresh: DataFrame, as_of: date, last_trained: DataFrame | None = None
) -> DataFrame:
    """Delete the predictions from ``as_of`` on of the symbols forecast again, then add the new ones.

    An earlier prediction for a day that is predicted anew goes as well, so running twice gives what running
    once does. A symbol without new predictions keeps what it had. With ``last_trained`` (symbol, last_dt) the
    predictions later than the last training day go too, so a re-run over a weekend leaves no copy.
    """
    again = fresh.select("symbol").distinct().withColumn("is_fresh", F.lit(True))
    stale = F.col("prediction_for") >= F.lit(as_of)
    rows = existing.join(again, "symbol", "left")
    if last_trained is not None:
        rows = rows.join(last_trained.select("symbol", "last_dt"), "symbol", "left")
        stale = stale | (F.col("prediction_for") > F.col("last_dt"))
    kept = without(rows, F.col("is_fresh") & stale).select(*existing.columns)
    kept = kept.join(fresh.select("symbol", "prediction_for"), ["symbol", "prediction_for"], "left_anti")
    kept = kept.select(*existing.columns)
    return kept.unionByName(fresh.select(*existing.columns))
