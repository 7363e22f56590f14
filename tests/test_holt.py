import math
from datetime import date, datetime, timedelta

import pytest

from dailybars.operators import forecast as fc
from dailybars.operators import holt
from dailybars.plans.forecasts import register_forecast_function, run_forecast
from dailybars.operators.report import prediction_errors
from dailybars.settings import Settings

DAY = datetime(2024, 1, 1)
SERIES = {
    "LINE": [float(3 * i + 5) for i in range(20)],
    "WAVE": [50 + 10 * math.sin(i / 3) + i % 5 for i in range(60)],
    "TURN": [float(i) for i in range(25)] + [50.0 - 2 * i for i in range(25)],
    "THREE": [1.0, 4.0, 2.0],
    "TWO": [1.0, 2.0],
    "INF": [1.0, float("inf"), 3.0, 4.0],
}


def states(ys, a, b):
    level, trend, sse, seen = ys[1], ys[1] - ys[0], 0.0, [(ys[1], ys[1] - ys[0])]
    for y in ys[2:]:
        error = y - level - trend
        level, trend = level + trend + a * error, trend + a * b * error
        sse += error * error
        seen.append((level, trend))
    return sse, seen


@pytest.fixture
def train(spark):
    rows = [(s, DAY + timedelta(days=i), y) for s, ys in SERIES.items() for i, y in enumerate(ys)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double")


def best(ys):
    return min(((states(ys, a, b)[0], i, a, b) for i, (a, b) in enumerate(holt.WEIGHTS)))


def test_weights_and_state(train):
    got = {r.symbol: r for r in holt.fit(train).collect()}
    for symbol in ("LINE", "WAVE", "TURN", "THREE"):
        sse, _, a, b = best(SERIES[symbol])
        row = got[symbol]
        assert (row.status, row.alpha, row.beta, row.train_rows) == ("ok", a, b, len(SERIES[symbol]))
        assert (row.level, row.trend) == pytest.approx(states(SERIES[symbol], a, b)[1][-1])
        assert row.sse == pytest.approx(sse)
    assert {s: got[s].status for s in ("TWO", "INF")} == {"TWO": "skipped", "INF": "skipped"} and got["TWO"].level is None


def test_a_line_is_carried_on_and_a_turn_is_followed(train):
    rows = fc.forecast(holt.fit(train), 3, 0.95, DAY, "holt").collect()
    line = {r.prediction_for: r for r in rows if r.symbol == "LINE"}
    day = date(2024, 1, 21)
    assert line[day].close_pred == pytest.approx(65) and line[day].upper_bound == pytest.approx(65)
    turned = min(r.prediction_for for r in rows if r.symbol == "TURN")
    straight = {r.prediction_for: r for r in fc.forecast(fc.fit(train), 3, 0.95, DAY).collect() if r.symbol == "TURN"}
    holts = next(r for r in rows if r.symbol == "TURN" and r.prediction_for == turned)
    assert abs(holts.close_pred - 0.0) < abs(straight[turned].close_pred - 0.0)


def test_standard_error_grows_as_errors_are_carried(train):
    fitted = {r.symbol: r for r in holt.fit(train).collect()}["WAVE"]
    rows = [r for r in fc.forecast(holt.fit(train), 6, 0.95, DAY, "holt").collect() if r.symbol == "WAVE"]
    z, n = fc.normal_quantile(0.95), len(SERIES["WAVE"])
    for h, row in enumerate(sorted(rows, key=lambda r: r.prediction_for), 1):
        carried = sum((fitted.alpha * (1 + fitted.beta * j)) ** 2 for j in range(1, h))
        want = z * math.sqrt(fitted.sse / (n - 2)) * math.sqrt(1 + carried)
        assert row.upper_bound - row.close_pred == pytest.approx(want)


def test_conformal_bounds_are_ranks_of_past_errors(train):
    got = {(r.symbol, r.h): r for r in holt.conformal(holt.fit(train), 4, 0.8).collect()}
    for symbol in ("WAVE", "TURN", "THREE"):
        ys = SERIES[symbol]
        _, _, a, b = best(ys)
        seen = states(ys, a, b)[1]
        for h in range(1, 5):
            errors = sorted(
                abs(ys[k + 1 + h] - level - h * trend) for k, (level, trend) in enumerate(seen) if k + 1 + h < len(ys)
            )
            rank = math.ceil((len(errors) + 1) * 0.8 - 1e-9)
            row = got[symbol, h]
            assert row.n_errors == len(errors)
            if rank <= len(errors):
                assert row.upper_bound - row.close_pred == pytest.approx(errors[rank - 1])
            else:
                assert row.upper_bound is None and row.lower_bound is None
    assert ("TWO", 1) not in got


def test_coverage_counts_held_out_rows(spark):
    rows = [(f"S{s}", DAY + timedelta(days=i), float((i * 7919 + s * 104729) % 101)) for s in range(30) for i in range(60)]
    train = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, close double")
    got = holt.coverage(train, 3, 0.8, fc.normal_quantile(0.8)).collect()
    assert sorted(r.h for r in got) == [1, 2, 3] and all(r.n_held_out == r.n_bounded == 30 for r in got)
    assert all(15 <= r.n_inside <= 30 for r in got)


def test_a_run_by_holt_kept_predictions_and_the_sql_function(store, spark, make_bars, daily):
    store.upsert("raw_bars", make_bars(daily("A", "2024-01-01", [10, 12, 11, 15, 14, 18]) + daily("B", "2024-01-01", [1, 2])))
    for as_of in (date(2024, 1, 5), date(2024, 1, 7)):
        settings = Settings(as_of, symbols=None, method="holt", horizon_days=4, keep_predictions=True)
        outcomes = run_forecast(store, settings)
    assert {(r.symbol, r.stage): r.status for r in outcomes.collect()}["A", "forecast"] == "ok"
    archive = store.read("forecast_archive")
    assert archive.count() == 8 and archive.select("created_at").distinct().count() == 2
    store.upsert("raw_bars", make_bars(daily("A", "2024-01-07", [20, 21])))
    errors = {r.dt: r for r in prediction_errors(store.read("raw_bars").where("symbol = 'A'"), archive).collect()}
    newest = {r.prediction_for: r for r in archive.where("created_at = TIMESTAMP_NTZ '2024-01-07'").collect()}
    # On the 8th the run of the 7th counts; on the 7th itself it was not made before the day.
    assert errors[date(2024, 1, 8)].created_at == datetime(2024, 1, 7)
    assert errors[date(2024, 1, 8)].error == pytest.approx(21 - newest[date(2024, 1, 8)].close_pred)
    assert errors[date(2024, 1, 7)].created_at == datetime(2024, 1, 5) and errors[date(2024, 1, 1)].close_pred is None
    register_forecast_function(store)
    got = [tuple(r) for r in spark.sql("SELECT * FROM forecast_of('A', 4) ORDER BY prediction_for").collect()]
    want = sorted((r.symbol, r.prediction_for, r.close_pred, r.lower_bound, r.upper_bound) for r in newest.values())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [x for g in got for x in g[2:]] == pytest.approx([x for w in want for x in w[2:]])
    assert spark.sql("SELECT * FROM forecast_of('B', 4)").count() == spark.sql("SELECT * FROM forecast_of('A', 0)").count() == 0
