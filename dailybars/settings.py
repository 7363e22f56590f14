"""Parameters of a run.

A run never looks at the clock: ``as_of`` is the run date and ``run_ts`` the run time, so the same
inputs give the same outputs whenever they are computed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from typing import Any

from dailybars.functions.symbols import parse_symbol_list

# Names under which a run's variables are stored, and their defaults.
DEFAULT_SYMBOLS = ("AAPL", "NVDA")
DEFAULT_LOOKBACK_DAYS = 180
DEFAULT_HORIZON_DAYS = 14
DEFAULT_PREDICTION_INTERVAL = 0.95
DEFAULT_RAW_SCHEMA = "RAW"
DEFAULT_ANALYTICS_SCHEMA = "ANALYTICS"
VARIABLE_NAMES = {
    "symbols": ("yf_tickers", "symbols"),
    "ingest_lookback_days": ("yf_lookback_days",),
    "train_lookback_days": ("train_lookback_days",),
    "horizon_days": ("forecast_horizon_days",),
    "prediction_interval": ("forecast_prediction_interval",),
    "raw_schema": ("yf_target_schema", "sf_source_schema"),
    "analytics_schema": ("sf_analytics_schema",),
}

METHODS = ("trend", "drift", "holt")
SNAPSHOT_STRATEGIES = ("timestamp", "check")


@dataclass(frozen=True)
class Settings:
    """One run. ``symbols=None`` means every symbol found in the data; given ones are trimmed and upper-cased.

    ``lenient`` leaves out rows that do not fit and counts them; ``legacy_final`` shows the final table by symbol
    under its older column names; ``keep_predictions`` keeps what each run predicted, for comparison with what came.
    ``quarantine`` puts lines that cannot be read into ``rejected_lines`` instead of failing the load.
    """

    as_of: date
    symbols: tuple[str, ...] | None = DEFAULT_SYMBOLS
    ingest_lookback_days: int = DEFAULT_LOOKBACK_DAYS
    train_lookback_days: int = DEFAULT_LOOKBACK_DAYS
    horizon_days: int = DEFAULT_HORIZON_DAYS
    prediction_interval: float = DEFAULT_PREDICTION_INTERVAL
    raw_schema: str = DEFAULT_RAW_SCHEMA
    analytics_schema: str = DEFAULT_ANALYTICS_SCHEMA
    method: str = "trend"
    business_days: bool = False
    strict_replace: bool = False
    lenient: bool = False
    legacy_final: bool = False
    keep_predictions: bool = False
    quarantine: bool = False
    snapshot_strategy: str = "timestamp"
    run_ts: datetime | None = None

    def __post_init__(self) -> None:
        if not 0.0 < self.prediction_interval < 1.0:
            raise ValueError(f"prediction_interval must lie between 0 and 1: {self.prediction_interval}")
        if self.horizon_days < 1 or self.ingest_lookback_days < 0 or self.train_lookback_days < 0:
            raise ValueError("the horizon is at least one day, a lookback is not negative")
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}: {self.method!r}")
        if self.snapshot_strategy not in SNAPSHOT_STRATEGIES:
            raise ValueError(f"snapshot_strategy must be one of {SNAPSHOT_STRATEGIES}")
        if self.symbols is not None:
            object.__setattr__(self, "symbols", parse_symbol_list(tuple(self.symbols)))
        if self.run_ts is None:
            object.__setattr__(self, "run_ts", datetime.combine(self.as_of, datetime.min.time()))

    @property
    def ingest_start(self) -> date:
        return self.as_of - timedelta(days=self.ingest_lookback_days)

    @property
    def train_start(self) -> date:
        return self.as_of - timedelta(days=self.train_lookback_days)

    @classmethod
    def from_variables(cls, variables: Mapping[str, Any], as_of: date, **overrides: Any) -> Settings:
        """Build settings from stored run variables; a value that cannot be read keeps its default."""
        values: dict[str, Any] = {}
        for field, names in VARIABLE_NAMES.items():
            raw = next((variables[n] for n in names if variables.get(n) is not None), None)
            if raw is None:
                continue
            try:
                values[field] = _READERS[field](raw)
            except (TypeError, ValueError):
                continue
        interval = values.get("prediction_interval")
        if interval is not None and not 0.0 < interval < 1.0:
            del values["prediction_interval"]
        return cls(as_of=as_of, **{**values, **overrides})


def _symbols(raw: Any) -> tuple[str, ...]:
    parsed = parse_symbol_list(raw)
    if not parsed:
        raise ValueError("no symbols")
    return parsed


_READERS = {
    "symbols": _symbols,
    "ingest_lookback_days": int,
    "train_lookback_days": int,
    "horizon_days": int,
    "prediction_interval": float,
    "raw_schema": str,
    "analytics_schema": str,
}
