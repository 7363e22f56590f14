"""All three runs, one after the other."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession

from dailybars.functions.symbols import safe_name
from dailybars.operators.forecast import LEGACY_NAMES
from dailybars.plans.etl import run_etl
from dailybars.plans.forecasts import run_forecast
from dailybars.plans.models import run_models
from dailybars.settings import Settings
from dailybars.sources.tables import TABLES, TableStore


@dataclass(frozen=True)
class RunResult:
    loaded: int
    outcomes: DataFrame
    checks: list[Row]


def run_all(
    store: TableStore,
    settings: Settings,
    landing: str,
    fmt: str = "records",
    incremental: bool = False,
    landed_since: date | None = None,
) -> RunResult:
    """``incremental`` builds only the months the load can have touched; ``landed_since`` opens only what has
    landed from that day on."""
    since = settings.ingest_start if incremental and store.exists("stock_summary") else None
    loaded = run_etl(store, settings, landing, fmt, landed_since)
    forecast_outcomes = run_forecast(store, settings)
    checks = run_models(store, settings, since)
    return RunResult(loaded.n_rows, loaded.outcomes.unionByName(forecast_outcomes), checks)


def store_for(spark: SparkSession, root: str, settings: Settings, prefix: str = "") -> TableStore:
    """Tables below ``root``, bars in the raw schema and everything else in the analytics schema.

    ``prefix`` goes before the schemas' names, for several sets of tables in one catalog.
    """
    raw, analytics, snapshot = (prefix + x for x in (settings.raw_schema, settings.analytics_schema, "SNAPSHOT"))
    return TableStore(
        spark,
        root,
        {
            "raw_bars": raw,
            "partial_bars": raw,
            "arrivals": raw,
            "models": analytics,
            "forecasts": analytics,
            "forecast_archive": analytics,
            "final": analytics,
            "stock_summary": analytics,
            "kpi_months": analytics,
            "summary_tail": analytics,
            "snapshot": snapshot,
            "snapshot_digests": snapshot,
            "rejected_lines": raw,
            "etl_outcomes": raw,
            "forecast_outcomes": analytics,
        },
    )


def register_symbol_views(store: TableStore, settings: Settings) -> list[str]:
    """Names for SQL: the shared tables, and for each symbol of the run its own views in the analytics schema.

    A symbol S gets S (its bars), V_TRAIN_S, S_FORECAST and S_FINAL, with characters that an unquoted
    name cannot hold replaced by ``_``; two symbols with one such name are refused. The views select from the
    tables' names, so they show what the last load or run has published. The same names without a schema are
    temporary views. ``settings.legacy_final`` gives S_FINAL its older column names.
    """
    safe_names = {symbol: safe_name(symbol) for symbol in settings.symbols or ()}
    for safe in set(safe_names.values()):
        sharing = [symbol for symbol, name in safe_names.items() if name.upper() == safe.upper()]
        if len(sharing) > 1:
            raise ValueError(f"symbols {sharing} would share the name {safe}")
    store.ensure()
    spark, start = store.spark, settings.train_start.isoformat()
    where = {name: store.full_name(name) for name in TABLES}
    columns = {name: ", ".join(table.schema.fieldNames()) for name, table in TABLES.items()}
    for name in TABLES:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns[name]} FROM {where[name]}")
    final = [f"{c} AS {LEGACY_NAMES[c]}" if settings.legacy_final and c in LEGACY_NAMES else c for c in TABLES["final"].schema.fieldNames()]
    names = []
    for symbol, safe in safe_names.items():
        own = "symbol = '" + symbol.replace("\\", "\\\\").replace("'", "\\'") + "'"
        views = {
            safe: f"SELECT {columns['raw_bars']} FROM {where['raw_bars']} WHERE {own}",
            f"V_TRAIN_{safe}": f"SELECT CAST(dt AS timestamp_ntz) AS ts, close FROM {where['raw_bars']} "
            f"WHERE {own} AND dt >= DATE '{start}' AND close IS NOT NULL AND NOT isnan(close)",
            f"{safe}_FORECAST": f"SELECT {columns['forecasts']} FROM {where['forecasts']} WHERE {own}",
            f"{safe}_FINAL": f"SELECT {', '.join(final)} FROM {where['final']} WHERE {own}",
        }
        for name, sql in views.items():
            full = f"`{store.schema_name('final')}`.`{name}`"
            spark.sql(f"CREATE OR REPLACE VIEW {full} AS {sql}")
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW `{name}` AS SELECT * FROM {full}")
        names += views
    return names
