from datetime import date, datetime

from dailybars.sources.ticks import daily_bars

TICKS = [
    (1, datetime(2024, 1, 1, 9), "a", 5.0),
    (2, datetime(2024, 1, 1, 9), "a", 7.0),
    (3, datetime(2024, 1, 1, 17), "a", 2.0),
    (4, datetime(2024, 1, 1, 17), "a", 6.0),
    (5, datetime(2024, 1, 2, 0), "a", 8.0),
    (6, datetime(2024, 1, 1, 12), "b", 1.0),
]


def ticks(spark):
    return spark.createDataFrame(TICKS, "id bigint, ts timestamp_ntz, s string, v double")


def test_one_bar_per_symbol_and_day(spark):
    bars = {tuple(r) for r in daily_bars(ticks(spark), "s", "ts", "v", "id").collect()}
    assert bars == {
        ("a", date(2024, 1, 1), 5.0, 7.0, 2.0, 6.0, 4),
        ("a", date(2024, 1, 2), 8.0, 8.0, 8.0, 8.0, 1),
        ("b", date(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, 1),
    }


def test_window_has_no_end_day(spark):
    bars = daily_bars(ticks(spark), "s", "ts", "v", "id", date(2024, 1, 1), date(2024, 1, 2))
    assert {r.dt for r in bars.collect()} == {date(2024, 1, 1)}


def test_bars_hold_their_prices(spark):
    for row in daily_bars(ticks(spark), "s", "ts", "v", "id").collect():
        assert row.low <= min(row.open, row.close) <= max(row.open, row.close) <= row.high
