import math
from datetime import date, datetime, timedelta

import numpy as np
import pytest

from dailybars import schemas
from dailybars.operators import forecast as fc
from dailybars.operators.merge import replace_forecasts

AS_OF = date(2024, 2, 1)
NOW = datetime(2024, 2, 1, 6)
Z95 = 1.959963984540054


def fitted(bars, as_of=AS_OF, days=180):
    return fc.fit(fc.train_rows(bars, as_of, days))


def made(bars, horizon=14, interval=0.95, **more):
    return fc.forecast(fitted(bars), horizon, interval, NOW, **more)


def sorted_rows(frame):
    return sorted(frame.collect(), key=lambda r: (r.symbol, r.prediction_for))


def test_trend_against_least_squares(make_bars, daily):
    closes = [10, 12, 11, 15, 14, 18]
    rows = [r for i, r in enumerate(daily("A", "2024-01-10", closes)) if i != 3]
    x = np.array([0, 1, 2, 4, 5], float)
    y = np.array([10, 12, 11, 14, 18], float)
    b, a = np.polyfit(x, y, 1)
    s = math.sqrt(((y - a - b * x) ** 2).sum() / 3)
    out = sorted_rows(made(make_bars(rows), 3))
    assert [r.prediction_for for r in out] == [date(2024, 1, 15) + timedelta(days=h) for h in (1, 2, 3)]
    for h, row in enumerate(out, 1):
        xh = 5 + h
        se = s * math.sqrt(1 + 1 / 5 + (xh - x.mean()) ** 2 / ((x - x.mean()) ** 2).sum())
        assert row.close_pred == pytest.approx(a + b * xh)
        assert row.lower_bound == pytest.approx(a + b * xh - Z95 * se)
        assert row.upper_bound == pytest.approx(a + b * xh + Z95 * se)
        assert row.ts == datetime.combine(row.prediction_for, datetime.min.time())


def test_drift_against_plain_python(make_bars, daily):
    closes = [10, 12, 11, 15]
    steps = np.diff(closes)
    out = sorted_rows(made(make_bars(daily("A", "2024-01-10", closes)), 3, method="drift"))
    for h, row in enumerate(out, 1):
        se = steps.std(ddof=1) * math.sqrt(h * (1 + h / 3))
        assert row.close_pred == pytest.approx(15 + h * 5 / 3)
        assert row.upper_bound - row.close_pred == pytest.approx(Z95 * se)


@pytest.mark.parametrize("method", ["trend", "drift"])
def test_constant_close_has_no_spread(make_bars, daily, method):
    for row in made(make_bars(daily("A", "2024-01-10", [7.25] * 10)), method=method).collect():
        assert row.lower_bound == row.close_pred == row.upper_bound == 7.25


@pytest.mark.parametrize("method", ["trend", "drift"])
def test_bounds_are_ordered_and_wider_for_a_wider_interval(make_bars, daily, method):
    bars = make_bars(daily("A", "2024-01-10", [1, 5, 2, 8]) + daily("B", "2024-01-10", [3, 3, 9]))
    narrow = sorted_rows(made(bars, interval=0.5, method=method))
    wide = sorted_rows(made(bars, interval=0.99, method=method))
    assert len(narrow) == len(wide) == 2 * 14
    for n, w in zip(narrow, wide):
        assert w.lower_bound < n.lower_bound < n.close_pred == w.close_pred < n.upper_bound < w.upper_bound


def test_too_few_rows_are_skipped_and_others_go_on(spark, make_bars, daily):
    bars = make_bars(daily("A", "2024-01-10", [1, 2, 3]) + daily("B", "2024-01-10", [1, 2]))
    models = fitted(bars)
    preds = fc.forecast(models, 14, 0.95, NOW)
    assert {r.symbol for r in preds.collect()} == {"A"}
    requested = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    out = fc.outcomes(models, preds, date(2024, 1, 1), requested).collect()
    assert {(r.symbol, r.stage, r.status, r.n_rows, r.message) for r in out} == {
        ("A", "train", "ok", 3, "ok (train_rows=3)"),
        ("A", "forecast", "ok", 14, "ok (pred_rows=14)"),
        ("B", "train", "skipped", 2, "skipped: too few rows (2)"),
        ("B", "forecast", "skipped", 0, "skipped: no model"),
        ("C", "train", "skipped", 0, "skipped: too few rows (0)"),
        ("C", "forecast", "skipped", 0, "skipped: no model"),
    }


def test_training_leaves_out_old_days_and_missing_closes(make_bars):
    old, new = date(2023, 1, 1), date(2024, 1, 10)
    bars = make_bars([("A", old, 1.0), ("A", new, 2.0), ("A", date(2024, 1, 11), None)])
    train = fc.train_rows(bars, AS_OF, 180)
    assert train.schema.simpleString() == schemas.TRAIN.simpleString()
    assert [r.close for r in train.collect()] == [2.0]


def test_business_days_against_numpy(make_bars, daily):
    for last in range(1, 8):  # Monday 2024-01-01 .. Sunday 2024-01-07
        first = (date(2024, 1, last) - timedelta(days=3)).isoformat()
        out = sorted_rows(made(make_bars(daily("A", first, [1, 2, 3, 5])), 12, business_days=True))
        start = np.datetime64(date(2024, 1, last))
        want = [np.busday_offset(start, h, roll="backward") for h in range(1, 13)]
        assert [np.datetime64(r.prediction_for) for r in out] == want


def test_rerun_replaces_predictions_from_the_run_date(make_bars, daily):
    first = made(make_bars(daily("A", "2024-01-10", [1, 2, 4])), 5)  # 13th .. 17th
    again = made(make_bars(daily("A", "2024-01-10", [1, 2, 5])), 5)
    as_of = date(2024, 1, 15)
    once = replace_forecasts(first, again, as_of)
    assert sorted_rows(once) == sorted_rows(again)  # one row per key, also for the days before the run date
    assert sorted_rows(replace_forecasts(once, again, as_of)) == sorted_rows(once)
    strict = replace_forecasts(first, again, as_of, fitted(make_bars(daily("A", "2024-01-10", [1, 2, 5]))))
    assert strict.count() == 5
    twice = replace_forecasts(strict, again, as_of, fitted(make_bars(daily("A", "2024-01-10", [1, 2, 5]))))
    assert sorted_rows(twice) == sorted_rows(strict)


def test_symbol_without_new_predictions_keeps_the_old_ones(make_bars, daily):
    both = made(make_bars(daily("A", "2024-01-10", [1, 2, 4]) + daily("B", "2024-01-10", [1, 2, 4])), 3)
    only_a = made(make_bars(daily("A", "2024-01-10", [1, 2, 5])), 3)
    kept = replace_forecasts(both, only_a, date(2024, 1, 1))
    assert sorted((r.symbol for r in kept.collect())) == ["A"] * 3 + ["B"] * 3


def test_final_table(make_bars, daily):
    bars = make_bars(
        daily("A", "2024-01-20", [1, 2, 3])
        + [("A", date(2024, 1, 23), 1.0, 1.0, 1.0, None, 5), ("A", date(2020, 1, 1), 9.0)]
    )
    final = fc.final_table(bars, made(bars), AS_OF, 180, NOW)
    assert final.schema.simpleString() == schemas.FINAL.simpleString()
    rows = final.collect()
    raw = [r for r in rows if r.source == "RAW"]
    predicted = [r for r in rows if r.source == "FORECAST"]
    assert {r.dt.day for r in raw} == {20, 21, 22, 23}  # the bar without a close stays
    assert all(r.close_forecast is None for r in raw)
    assert {r.dt for r in predicted} == {AS_OF + timedelta(days=d) for d in range(5)}
    assert all(r.close is None and r.volume is None and r.created_at == NOW for r in predicted)
    legacy = fc.legacy_names(final).collect()
    upper = {(r.dt, r.upper_bound_forecast) for r in predicted}
    assert {(r.dt, r.open_bound_forecast) for r in legacy if r.source == "FORECAST"} == upper
