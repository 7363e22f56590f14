import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from dailybars.operators import ranges, report


@pytest.fixture
def bars(make_bars):
    rng = random.Random(2)
    rows = []
    for symbol, share in (("DENSE", 1.0), ("THIN", 0.03), ("LATE", 0.5)):
        for d in range(500):
            day = date(2023, 1, 1) + timedelta(days=d)
            if rng.random() < share and (symbol != "LATE" or d > 300):
                close = rng.choice([None, float("nan")]) if rng.random() < 0.1 else 10 + rng.random()
                rows.append((symbol, day, rng.choice([0.0, float("nan"), 10.0, 11.0, 12.0]), 15.0, 5.0, close, 1))
    return make_bars(rows).cache()


@pytest.mark.parametrize(
    "start, end",
    [
        (date(2023, 2, 10), date(2024, 3, 20)),
        (date(2023, 2, 1), date(2023, 12, 31)),
        (date(2023, 5, 3), date(2023, 5, 20)),
        (date(2023, 5, 3), date(2023, 6, 20)),
        (date(2023, 5, 1), date(2023, 5, 31)),
        (date(2024, 2, 1), date(2024, 2, 29)),
        (date(2030, 1, 1), date(2030, 3, 1)),
    ],
)
def test_range_equals_the_direct_kpis(bars, start, end):
    asked = []

    def between(since, until):
        asked.append((since, until))
        return bars.where(F.col("dt").between(F.lit(since), F.lit(until)))

    got = {r.symbol: r for r in ranges.range_kpis(between, ranges.month_parts(bars), start, end).collect()}
    returns = {r.symbol: r for r in report.total_return(bars, start, end).collect()}
    spread = {r.symbol: r.volatility for r in report.volatility(bars, start, end).collect()}
    assert set(got) == set(returns)
    for symbol, row in got.items():
        assert (row.first_dt, row.last_dt, row.first_close, row.last_close) == tuple(returns[symbol][1:5])
        assert row.total_return_pct == pytest.approx(returns[symbol].total_return_pct, rel=1e-9)
        assert row.volatility == (None if spread[symbol] is None else pytest.approx(spread[symbol], rel=1e-9))
    # Only cut months are read as bars.
    assert all((until - since).days < 31 for since, until in asked) or ranges.whole_months(start, end) is None
    assert len(asked) <= 2


def test_whole_months():
    assert ranges.whole_months(date(2024, 1, 1), date(2024, 2, 29)) == (date(2024, 1, 1), date(2024, 2, 1))
    assert ranges.whole_months(date(2023, 12, 2), date(2024, 2, 28)) == (date(2024, 1, 1), date(2024, 1, 1))
    assert ranges.whole_months(date(2024, 1, 2), date(2024, 1, 31)) is None
