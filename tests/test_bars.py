import math
import statistics
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dailybars import schemas
from dailybars.operators import bars as ops
from dailybars.operators import report

DAY = date(2024, 1, 5)


def by_day(frame):
    return [row for row in sorted(frame.collect(), key=lambda r: (r.symbol, r.dt))]


def test_rows_without_day_or_close_are_dropped(spark):
    rows = [
        ("A", DAY, 1.0, 1.0, 1.0, 1.0, 1),
        ("A", None, 1.0, 1.0, 1.0, 1.0, 1),
        ("A", date(2024, 1, 6), 1.0, 1.0, 1.0, None, 1),
        ("A", date(2024, 1, 7), None, None, None, 3.0, None),
    ]
    summary = by_day(ops.summary(spark.createDataFrame(rows, schemas.RAW_BARS)))
    assert [r.dt.day for r in summary] == [5, 7]
    assert summary[1].ma_7_day == 2.0
    assert summary[1].daily_range is None


def test_zero_open_gives_no_return(make_bars):
    row = ops.summary(make_bars([("A", DAY, 0.0, 2.0, 0.0, 1.0, 1)])).first()
    assert row.daily_return_pct is None
    assert row.daily_range == 2.0


def test_frames_count_rows_not_days(make_bars):
    friday, monday = date(2024, 1, 5), date(2024, 1, 8)
    summary = by_day(ops.summary(make_bars([("A", friday, 1.0), ("A", monday, 3.0)])))
    assert [r.ma_7_day for r in summary] == [1.0, 2.0]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.tuples(st.sampled_from("ABC"), st.integers(0, 90)),
        st.floats(-1e6, 1e6, allow_nan=False),
        min_size=1,
        max_size=120,
    )
)
def test_moving_averages_against_plain_python(make_bars, points):
    start = date(2024, 1, 1).toordinal()
    rows = [(s, date.fromordinal(start + d), c) for (s, d), c in points.items()]
    got = {(r.symbol, r.dt): r for r in ops.summary(make_bars(rows)).collect()}
    assert len(got) == len(rows)
    for symbol in "ABC":
        own = sorted((d, c) for s, d, c in rows if s == symbol)
        for i, (day, _) in enumerate(own):
            for name, n in (("ma_7_day", 7), ("ma_30_day", 30)):
                want = statistics.fmean(c for _, c in own[max(0, i - n + 1) : i + 1])
                assert math.isclose(got[symbol, day][name], want, rel_tol=1e-9, abs_tol=1e-6)


def test_any_set_of_symbols(make_bars):
    bars = make_bars([("A", DAY, 1.0), ("B", DAY, 1.0), ("C", DAY, 1.0)])
    assert {r.symbol for r in ops.stage_bars(bars, ["A", "C", "Z"]).collect()} == {"A", "C"}


def test_lookback_has_no_upper_limit(make_bars):
    days = [date(2024, 1, 1), date(2024, 1, 2), date(2030, 1, 1)]
    kept = ops.lookback(make_bars([("A", d, 1.0) for d in days]), date(2024, 1, 12), 10)
    assert {r.dt for r in kept.collect()} == set(days[1:])


def test_kpis(make_bars, daily):
    bars = make_bars(daily("A", "2024-01-01", [10, 20, 15]) + daily("Z", "2024-01-01", [0, 5]))
    latest = {r.symbol: (r.dt, r.close) for r in report.latest_price(bars).collect()}
    assert latest["A"] == (date(2024, 1, 3), 15.0)
    returns = {r.symbol: r.total_return_pct for r in report.total_return(bars).collect()}
    assert returns["A"] == pytest.approx(50.0)
    assert returns["Z"] is None
    ranged = report.total_return(bars, date(2024, 1, 2), date(2024, 1, 3)).collect()
    assert {r.symbol: r.first_close for r in ranged} == {"A": 20.0, "Z": 5.0}


def test_volatility(make_bars, daily):
    closes = [10.0, 11.0, 9.0, 12.0]
    bars = make_bars(daily("A", "2024-01-01", closes) + daily("B", "2024-01-01", [10]))
    returns = [(c - 10.0) / 10.0 * 100 for c in closes]
    got = {r.symbol: r.volatility for r in report.volatility(bars).collect()}
    assert got["A"] == pytest.approx(statistics.stdev(returns))
    assert got["B"] is None
    rolling = by_day(ops.rolling_deviation(bars, 2))
    assert rolling[0].volatility_30_day is None
    assert rolling[3].volatility_30_day == pytest.approx(statistics.stdev(returns[2:]))


def test_latest_rows_of_one_symbol(make_bars, daily):
    bars = make_bars(daily("A", "2024-01-01", range(40)) + daily("B", "2024-01-01", range(40)))
    rows = report.latest_rows(ops.summary(bars), "A").collect()
    assert [r.close for r in rows] == [float(c) for c in range(39, 9, -1)]
