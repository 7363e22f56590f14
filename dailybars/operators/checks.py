"""Data tests: each gives the number of rows (or values, or keys) that fail it."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from dailybars import schemas

# Columns of the summary that must be present in every row.
SUMMARY_NOT_NULL = ("symbol", "dt", "close", "volume")


class CheckFailed(RuntimeError):
    """At least one data test found failing rows."""


def _as_rows(totals: DataFrame, labels: Sequence[tuple[str, str]], counts: Sequence[Column]) -> DataFrame:
    rows = [
        F.struct(F.lit(check).alias("check_name"), F.lit(column).alias("column_name"), n.alias("failures"))
        for (check, column), n in zip(labels, counts)
    ]
    return totals.select(F.inline(F.array(*rows)))


def not_null(rows: DataFrame, columns: Sequence[str] = SUMMARY_NOT_NULL) -> DataFrame:
    """All columns in one pass."""
    totals = rows.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return _as_rows(totals, [("not_null", name) for name in columns], [F.col(name) for name in columns])


def unaccepted_values(rows: DataFrame, column: str, accepted: Iterable[str]) -> DataFrame:
    """Values outside the accepted ones, with their row counts; a NULL is not a value."""
    return (
        rows.where(~F.col(column).isin(list(accepted)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_summary(
    rows: DataFrame,
    accepted_symbols: Iterable[str] | None,
    columns: Sequence[str] = SUMMARY_NOT_NULL,
) -> DataFrame:
    """Every test of the summary from one scan: (check_name, column_name, failures).

    Rows are counted per key first, for the uniqueness test; the other tests are sums over those
    counts, so the table is read once and only counts cross the second shuffle.
    """
    others = [name for name in columns if name not in schemas.KEY]
    per_key = rows.groupBy(*schemas.KEY).agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(name).isNull()).alias(name) for name in others)
    )
    nulls_in_key = {
        name: F.sum(F.when(F.col(name).isNull(), F.col("n")).otherwise(0)).alias(f"no_{name}")
        for name in schemas.KEY
    }
    per_symbol = per_key.groupBy("symbol").agg(
        *nulls_in_key.values(),
        *(F.sum(name).alias(f"no_{name}") for name in others),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )
    accepted = F.lit(True) if accepted_symbols is None else F.col("symbol").isin(list(accepted_symbols))
    totals = per_symbol.agg(
        *(F.sum(f"no_{name}").alias(f"no_{name}") for name in columns),
        F.count_if(~accepted).alias("unaccepted"),
        F.sum("repeated_keys").alias("repeated_keys"),
    )
    labels = [("not_null", name) for name in columns]
    counts = [F.coalesce(f"no_{name}", F.lit(0).cast("bigint")) for name in columns]
    if accepted_symbols is not None:
        labels.append(("accepted_values", "symbol"))
        counts.append(F.col("unaccepted"))
    labels.append(("unique", "symbol, dt"))
    counts.append(F.coalesce("repeated_keys", F.lit(0).cast("bigint")))
    return _as_rows(totals, labels, counts)


def require_passing(checks: DataFrame) -> list[Row]:
    """The gate: raises when a test failed, else gives the results, one row per test."""
    results = checks.collect()
    failed = [row for row in results if row.failures > 0]
    if failed:
        raise CheckFailed(
            "; ".join(f"{row.check_name}({row.column_name}): {row.failures} failures" for row in failed)
        )
    return results
