import json
import random
from datetime import date, datetime, timedelta

import pytest

from dailybars.operators.checks import CheckFailed
from dailybars.plans.etl import run_etl
from dailybars.plans.forecasts import run_forecast
from dailybars.plans.full import register_symbol_views, run_all, store_for
from dailybars.plans.models import build_summary, refresh_summary, run_models
from dailybars.settings import Settings
from dailybars.sources.tables import TableStore


@pytest.fixture(autouse=True)
def no_schemas(spark):
    """The catalog's schemas of earlier tests, whose tables lie elsewhere."""
    yield
    for name in ("RAW", "ANALYTICS", "SNAPSHOT"):
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def land(tmp_path, symbols, first, days, shift=0.0):
    folder = tmp_path / "landing"
    folder.mkdir(exist_ok=True)
    lines = [
        json.dumps(
            {
                "Date": str(date.fromisoformat(first) + timedelta(days=d)),
                "Open": 10 + d,
                "High": 13 + d,
                "Low": 9 + d,
                "Close": 11 + d + (d % 3) + shift,
                "Volume": 100 + d,
                "Symbol": symbol,
            }
        )
        for symbol in symbols
        for d in range(days)
    ]
    (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(lines))
    return str(folder)


def test_whole_run_and_its_views(spark, tmp_path):
    settings = Settings(date(2024, 1, 31), symbols=("BRK.B", "NVDA"), horizon_days=5)
    store = store_for(spark, str(tmp_path / "tables"), settings)
    landing = land(tmp_path, ["brk.b", "nvda", "other"], "2024-01-01", 30)
    result = run_all(store, settings, landing)
    assert result.loaded == 60
    assert {(r.symbol, r.stage, r.status) for r in result.outcomes.collect()} == {
        (s, stage, "ok") for s in settings.symbols for stage in ("extract", "train", "forecast")
    }
    assert all(row.failures == 0 for row in result.checks)
    assert store.read("stock_summary").count() == 60
    assert store.read("snapshot").count() == 60
    assert store.read("final").count() == 60 + 10

    register_symbol_views(store, settings)
    latest = spark.sql("SELECT * FROM stock_summary WHERE symbol = 'BRK.B' ORDER BY dt DESC LIMIT 30")
    assert latest.count() == 30
    assert spark.sql("SELECT * FROM BRK_B_FORECAST WHERE prediction_for >= DATE '2024-01-31'").count() == 5
    final = spark.sql("SELECT * FROM NVDA_FINAL ORDER BY dt DESC").collect()
    assert [r.source for r in final] == ["FORECAST"] * 5 + ["RAW"] * 30
    assert spark.sql("SELECT ts, close FROM V_TRAIN_NVDA").count() == 30
    assert spark.sql("SELECT * FROM NVDA").count() == 30


def test_second_day_changes_only_what_is_new(store, tmp_path):
    first = Settings(date(2024, 1, 30), symbols=None, run_ts=datetime(2024, 1, 30, 6))
    run_all(store, first, land(tmp_path, ["A", "B"], "2024-01-01", 29))
    history = {r.scd_id for r in store.read("snapshot").collect()}
    second = Settings(date(2024, 1, 31), symbols=None, run_ts=datetime(2024, 1, 31, 6))
    run_all(store, second, land(tmp_path, ["A", "B"], "2024-01-30", 1))
    after = store.read("snapshot").collect()
    assert len(after) == 60 and history < {r.scd_id for r in after}
    forecasts = store.read("forecasts")
    assert forecasts.where("prediction_for >= DATE '2024-01-31'").count() == 2 * 14
    assert forecasts.where("prediction_for = DATE '2024-01-30'").count() == 2


def test_same_run_twice_gives_the_same_tables(store, tmp_path):
    settings = Settings(date(2024, 1, 31), symbols=None)
    landing = land(tmp_path, ["A"], "2024-01-01", 30)

    def tables():
        run_all(store, settings, landing)
        return [
            sorted(map(str, store.read(name).collect()))
            for name in ("raw_bars", "models", "forecasts", "final", "stock_summary", "snapshot")
        ]

    assert tables() == tables()


def test_other_symbols_keep_their_forecasts(store, tmp_path):
    landing = land(tmp_path, ["A", "B"], "2024-01-01", 30)
    both = Settings(date(2024, 1, 31), symbols=("A", "B"))
    run_etl(store, both, landing)
    run_forecast(store, both)
    run_forecast(store, Settings(date(2024, 1, 31), symbols=("A",), horizon_days=3))
    for name in ("forecasts", "final"):
        counts = {r.symbol: r["count"] for r in store.read(name).groupBy("symbol").count().collect()}
        assert counts == ({"A": 3, "B": 14} if name == "forecasts" else {"A": 33, "B": 44})
    assert {r.symbol for r in store.read("models").collect()} == {"A", "B"}


def test_late_run_over_a_month_end_keeps_earlier_predictions(store, tmp_path):
    landing = land(tmp_path, ["A"], "2024-01-01", 29)  # last bar on the 29th
    settings = Settings(date(2024, 1, 30), symbols=None)
    run_etl(store, settings, landing)
    run_forecast(store, settings)
    late = Settings(date(2024, 2, 2), symbols=None)
    run_forecast(store, late)
    rows = store.read("forecasts")
    assert rows.where("prediction_for < DATE '2024-02-02'").count() == 3
    assert rows.count() == rows.select("symbol", "prediction_for").distinct().count()
    assert rows.where("prediction_for >= DATE '2024-02-02'").count() == 11
    run_forecast(store, Settings(date(2024, 2, 2), symbols=None, strict_replace=True))
    assert store.read("forecasts").count() == 14


def test_failed_check_stops_before_the_history(store, tmp_path):
    landing = land(tmp_path, ["A"], "2024-01-01", 5)
    settings = Settings(date(2024, 1, 31), symbols=None)
    run_etl(store, settings, landing)
    run_models(store, settings)
    before = store.read("snapshot").count()
    broken = store.read("raw_bars").selectExpr(
        "symbol", "dt", "open", "high", "low", "close", "CAST(NULL AS BIGINT) AS volume"
    )
    store.upsert("raw_bars", broken)
    with pytest.raises(CheckFailed, match="volume"):
        run_models(store, settings)
    assert store.read("snapshot").count() == before


def test_nothing_to_forecast(store):
    store.ensure()
    settings = Settings(date(2024, 1, 31))
    out = run_forecast(store, settings).collect()
    assert {(r.symbol, r.status) for r in out} == {("AAPL", "skipped"), ("NVDA", "skipped")}
    assert build_summary(store, settings).count() == 0


def test_incremental_run_equals_a_whole_one(spark, tmp_path):
    """Symbols with long, gappy, short and no earlier history; restated bars in the load window."""
    rng = random.Random(7)
    start = date(2023, 9, 1)
    density = {"DENSE": 1.0, "GAPPY": 0.05, "RARE": 0.01, "YOUNG": 0.0, "GONE": 0.9}

    def lines(first, last, restated):
        for symbol, share in density.items():
            for d in range((last - first).days):
                day = first + timedelta(days=d)
                recent = day >= date(2024, 1, 10) and symbol != "GONE"
                if rng.random() < (0.5 if recent else share):
                    close = 10 + rng.random() + (5 if restated else 0)
                    yield json.dumps(
                        dict(date=str(day), open=1, high=20, low=1, close=close, volume=1, symbol=symbol)
                    )

    def land_all(name, first, last, restated):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "bars.json").write_text("\n".join(lines(first, last, restated)))
        return str(folder)

    old = land_all("old", start, date(2024, 1, 31), False)
    new = land_all("new", date(2024, 1, 20), date(2024, 2, 20), True)
    tables = []
    for incremental in (True, False):
        store = TableStore(spark, str(tmp_path / f"tables-{incremental}"))
        settings = Settings(date(2024, 1, 31), symbols=None, ingest_lookback_days=400)
        run_all(store, settings, old)
        late = Settings(
            date(2024, 2, 20), symbols=None, ingest_lookback_days=31, snapshot_strategy="check"
        )
        run_all(store, late, new, incremental=incremental)
        tables.append(
            [sorted(map(str, store.read(name).collect())) for name in ("stock_summary", "snapshot")]
        )
    assert tables[0] == tables[1]
    assert any("YOUNG" in row for row in tables[0][0])


def test_names_follow_the_tables(spark, tmp_path):
    settings = Settings(date(2024, 1, 11), symbols=("AAPL", "O'B"), horizon_days=3, legacy_final=True)
    store = store_for(spark, str(tmp_path / "tables"), settings)
    run_all(store, settings, land(tmp_path, ["AAPL", "O'B"], "2024-01-01", 10))
    register_symbol_views(store, settings)

    def rows(sql):
        return spark.sql(sql).count()

    assert rows("SELECT * FROM ANALYTICS.STOCK_SUMMARY WHERE symbol = 'AAPL'") == 10
    assert rows("SELECT * FROM ANALYTICS.AAPL_FINAL") == 13
    assert rows("SELECT * FROM RAW.RAW_BARS") == rows("SELECT * FROM raw_bars") == 20
    later = Settings(date(2024, 2, 5), symbols=settings.symbols, horizon_days=3)
    run_all(store, later, land(tmp_path, ["AAPL", "O'B"], "2024-01-11", 25))
    assert rows("SELECT * FROM ANALYTICS.STOCK_SUMMARY WHERE symbol = 'AAPL' ORDER BY dt DESC LIMIT 30") == 30
    assert rows("SELECT * FROM ANALYTICS.AAPL_FORECAST WHERE prediction_for >= DATE '2024-02-05'") == 3
    assert rows("SELECT * FROM ANALYTICS.O_B") == rows("SELECT * FROM O_B") == 35
    columns = spark.sql("SELECT * FROM ANALYTICS.AAPL_FINAL ORDER BY dt DESC").columns
    assert "open_bound_forecast" in columns and "upper_bound_forecast" not in columns
    assert "month" not in spark.sql("SELECT * FROM raw_bars").columns


def test_symbols_that_would_share_a_name_are_refused(store):
    with pytest.raises(ValueError, match="share the name"):
        register_symbol_views(store, Settings(date(2024, 1, 31), symbols=("BRK.B", "BRK_B")))


def test_given_symbols_are_cleaned(store, tmp_path):
    settings = Settings(date(2024, 1, 31), symbols=(" a", "b "))
    assert settings.symbols == ("A", "B")
    assert run_etl(store, settings, land(tmp_path, ["A", "B", "C"], "2024-01-01", 2)).n_rows == 4


def test_odd_closes_give_no_odd_predictions(store, spark, make_bars, daily):
    bars = daily("NAN", "2024-01-01", [1, 2, float("nan"), 4, 5]) + daily("INF", "2024-01-01", [1, float("inf"), 3, 4])
    store.upsert("raw_bars", make_bars(bars))
    outcomes = run_forecast(store, Settings(date(2024, 1, 10), symbols=None))
    assert {(r.symbol, r.stage): r.status for r in outcomes.collect()} == {
        ("NAN", "train"): "ok",
        ("NAN", "forecast"): "ok",
        ("INF", "train"): "skipped",
        ("INF", "forecast"): "skipped",
    }
    predictions = store.read("forecasts").collect()
    assert predictions and all(abs(r.close_pred) < 1e6 for r in predictions)


def test_new_and_thin_symbols_open_no_older_month(store, make_bars, daily):
    old = daily("A", "2023-01-01", range(1, 390)) + [("THIN", date(2023, 1, 1) + timedelta(days=40 * i), 5.0 + i) for i in range(9)]
    store.upsert("raw_bars", make_bars(old))
    first = Settings(date(2024, 1, 25), symbols=None, ingest_lookback_days=30)
    build_summary(store, first)
    store.upsert("raw_bars", make_bars(daily("A", "2024-01-20", range(50, 70)) + daily("NEW", "2024-02-01", [1, 2, 3]) + [("THIN", date(2024, 2, 3), 9.0)]))
    second = Settings(date(2024, 2, 10), symbols=None, ingest_lookback_days=30)

    opened = []
    read = store.read

    def watched(name, since=None, until=None):
        if name == "raw_bars":
            opened.append((since, until))
        return read(name, since, until)

    store.read = watched
    refresh_summary(store, second, second.ingest_start)
    store.read = read
    assert opened and all(since is not None and since >= date(2023, 12, 1) for since, _ in opened)
    got = sorted(map(str, store.read("stock_summary").collect()))
    build_summary(store, second)
    assert got == sorted(map(str, store.read("stock_summary").collect()))


def test_a_daily_run_needs_few_spark_jobs(store, spark, tmp_path):
    settings = Settings(date(2024, 1, 31), symbols=None)
    landing = land(tmp_path, ["A", "B"], "2024-01-01", 30)
    run_all(store, settings, landing)
    spark.sparkContext.setJobGroup("counted", "one run")
    run_all(store, settings, landing)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 110


def test_symbols_that_join_and_leave_an_incremental_run(spark, tmp_path, make_bars, daily):
    """Summary and history equal those of whole builds; an unchanged list opens no older month."""
    bars = make_bars([b for s, n in (("A", 100), ("B", 7), ("C", 50)) for b in daily(s, "2023-11-01", range(n, n + 100))])
    tables = []
    for incremental in (True, False):
        store = TableStore(spark, str(tmp_path / f"tables-{incremental}"))
        store.upsert("raw_bars", bars)
        for as_of, symbols in ((date(2024, 1, 20), ("A", "C")), (date(2024, 2, 9), ("A", "B"))):
            settings = Settings(as_of, symbols=symbols, ingest_lookback_days=20)
            since = settings.ingest_start if incremental and store.exists("stock_summary") else None
            run_models(store, settings, since)
        tables.append([sorted(map(str, store.read(name).collect())) for name in ("stock_summary", "snapshot")])
    assert tables[0] == tables[1]
    assert "B" in {row.split("symbol='")[1][0] for row in tables[0][0]}
