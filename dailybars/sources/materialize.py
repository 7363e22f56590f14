"""How a result is kept: inlined, as a view, or as a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from dailybars.sources.tables import TableStore

KINDS = ("inline", "view", "table")


def materialize(rows: DataFrame, name: str, kind: str = "view", store: TableStore | None = None) -> DataFrame:
    """``inline`` hands the rows on, ``view`` names them, ``table`` stores them and reads them back."""
    if kind == "inline":
        return rows
    if kind == "view":
        rows.createOrReplaceTempView(name)
        return rows
    if kind == "table":
        if store is None:
            raise ValueError("a table needs a store")
        store.overwrite(name, rows)
        return store.read(name)
    raise ValueError(f"kind must be one of {KINDS}: {kind!r}")
