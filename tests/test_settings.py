from datetime import date, datetime

import pytest

from dailybars.__main__ import parse, settings_of
from dailybars.functions.symbols import parse_symbol_list, safe_name
from dailybars.settings import Settings

AS_OF = date(2024, 3, 1)


def test_defaults():
    s = Settings(as_of=AS_OF)
    assert s.symbols == ("AAPL", "NVDA")
    assert (s.ingest_lookback_days, s.train_lookback_days, s.horizon_days) == (180, 180, 14)
    assert s.prediction_interval == 0.95
    assert s.train_start == date(2023, 9, 3)
    assert s.run_ts == datetime(2024, 3, 1)


def test_variables_are_read():
    s = Settings.from_variables(
        {
            "yf_tickers": '[" brk.b ", "aapl"]',
            "train_lookback_days": "90",
            "forecast_horizon_days": "7",
            "forecast_prediction_interval": "0.9",
            "sf_analytics_schema": "A2",
        },
        AS_OF,
    )
    assert s.symbols == ("BRK.B", "AAPL")
    assert (s.train_lookback_days, s.horizon_days, s.prediction_interval) == (90, 7, 0.9)
    assert s.analytics_schema == "A2"


def test_bad_values_keep_their_default():
    s = Settings.from_variables(
        {
            "yf_tickers": 17,
            "train_lookback_days": "many",
            "forecast_horizon_days": None,
            "forecast_prediction_interval": "7",
        },
        AS_OF,
    )
    assert s == Settings(as_of=AS_OF)


def test_wrong_settings_are_refused():
    with pytest.raises(ValueError):
        Settings(as_of=AS_OF, prediction_interval=1.0)
    with pytest.raises(ValueError):
        Settings(as_of=AS_OF, method="oracle")
    with pytest.raises(ValueError):
        Settings(as_of=AS_OF, horizon_days=0)
    with pytest.raises(ValueError):
        Settings(as_of=AS_OF, snapshot_strategy="guess")


@pytest.mark.parametrize(
    "raw, parsed",
    [
        ('["aapl", "nvda "]', ("AAPL", "NVDA")),
        ("aapl, nvda,,", ("AAPL", "NVDA")),
        (["aapl", " "], ("AAPL",)),
        ('"aapl"', ("AAPL",)),
    ],
)
def test_symbol_lists(raw, parsed):
    assert parse_symbol_list(raw) == parsed


def test_safe_name():
    assert safe_name("BRK.B") == "BRK_B"


def test_command_line():
    args = parse(
        ["all", "--root", "r", "--landing", "l", "--as-of", "2024-03-01"]
        + ["--variables", '{"yf_tickers": "[\\"abc\\"]", "forecast_horizon_days": "3"}', "--method", "drift"]
    )
    s = settings_of(args)
    assert (s.as_of, s.symbols, s.horizon_days, s.method) == (AS_OF, ("ABC",), 3, "drift")
    assert settings_of(parse(["forecast", "--root", "r", "--as-of", "2024-03-01", "--all-symbols"])).symbols is None
    with pytest.raises(SystemExit):
        parse(["etl", "--root", "r", "--as-of", "2024-03-01"])
